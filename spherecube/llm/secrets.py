"""Secrets in texts: fixed patterns, and strings whose characters look random. DataFrame functions only.

Candidate strings are runs of characters of a class. A window slides over a candidate; the counts of the window's
characters are kept as a string with one place for each character, and the entropy changes with the count that a leaving and
an entering character change. Logarithms are whole numbers, so that sums are exact. A candidate whose most random
window passes its class's threshold is a secret, unless an allow-list pattern explains it.

Text never leaves its row and nothing is shuffled. Places are running sums over the matches of a text, taken in blocks, so
that a text with very many matches doesn't copy its growing list for each of them.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20
BLOCK = 256
UNIT = 1 << 20

# fixed values: the patterns of the base spans; group 2 of the first is the secret itself
_WORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: every match of the first pattern holds the end of its word and the sign after it
ASSIGN_START = r"""[dDtTnNyY]["']?\x20*[:=]"""
BASE = ("assign", "access", "hex")


class CharacterClass(NamedTuple):
    """A kind of candidate: all of ``needs`` are found in it, and its most random window has ``bits`` a character."""

    kind: str
    needs: tuple[str, ...]
    bits: float


#: strings that are looked at: long runs of base-64 characters of either alphabet, with their padding
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: random hexadecimal digits have about 3.4 bits in a window of 20, random base-64 characters about 4.1
CLASSES = (
    CharacterClass("entropy_hex", ("^[0-9A-Fa-f]+$", "[0-9]", "[A-Fa-f]"), 3.0),
    CharacterClass("entropy_base64", ("[^0-9A-Fa-f]", "[0-9]", "[a-z]", "[A-Z]"), 3.85),
)
#: strings that look random and are not secret: identifiers, checksums with their name, rows of characters, placeholders
ALLOWED = (
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$", r"^(sha|SHA)(1|224|256|384|512)[-_]",
    r"[Ee]xample|EXAMPLE|[Pp]laceholder|PLACEHOLDER|abcdefgh|ABCDEFGH|01234567|12345678",
)


def _cost(count: int) -> int:
    return round(UNIT * count * math.log2(count)) if count else 0


#: what the k-th equal character adds to the sum of count * log2(count)
STEPS = tuple(_cost(k) - _cost(k - 1) for k in range(1, WINDOW + 1))


def limit_of(bits: float) -> int:
    """Largest sum of count * log2(count) over a window that still has ``bits`` of entropy a character."""
    return math.floor(UNIT * WINDOW * (math.log2(WINDOW) - bits))


def _running(sizes: Column) -> Column:
    """Sum of all numbers up to each place of an array."""
    return F.aggregate(sizes, F.array().cast("array<bigint>"), lambda done, x: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + x)))


def _running_in_blocks(sizes: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda k: _running(F.slice(sizes, k * BLOCK + 1, BLOCK)))
    ends = _running(F.transform(blocks, lambda b: F.element_at(b, -1)))
    return F.flatten(F.zip_with(blocks, F.concat(F.array(F.lit(0).cast("bigint")), F.slice(ends, 1, F.size(ends) - 1)), lambda b, base: F.transform(b, lambda x: x + base)))


def _spans(hits: Column, gaps: Column) -> Column:
    """Struct array of the matches: start, end (code points) and the matched string; ``gaps`` is the text between them."""
    sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: (F.length(gap) + F.length(hit)).cast("bigint"))
    spans = F.zip_with(_running_in_blocks(sizes), hits, lambda end, hit: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))
    return F.when(F.size(hits) > 0, spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>"))


def _most_random(hit: Column) -> Column:
    """Smallest sum of count * log2(count) over all windows of an ASCII string, by incremental counts."""
    letters = F.split(hit, "")
    event = lambda k, change: F.struct(letters[k - 1].alias("letter"), F.lit(change).alias("change"), (k >= WINDOW).alias("filled"))
    events = F.flatten(F.transform(F.sequence(F.lit(1), F.length(hit)), lambda k: F.when(k > WINDOW, F.array(event(k - WINDOW, -1), event(k, 1))).otherwise(F.array(event(k, 1)))))
    steps = F.array(*map(F.lit, STEPS))

    def slide(state: Column, e: Column) -> Column:
        place = F.ascii(e["letter"]) - 32
        count = F.ascii(F.substring(state["counts"], place, F.lit(1))) - 32
        total = state["total"] + e["change"] * steps[count + F.when(e["change"] > 0, 0).otherwise(-1)]
        return F.struct(
            F.overlay(state["counts"], F.char(count + e["change"] + 32), place, F.lit(1)).alias("counts"), total.alias("total"),
            F.when((e["change"] > 0) & e["filled"], F.least(state["best"], total)).otherwise(state["best"]).alias("best"),
        )

    start = F.struct(F.lit(" " * 96).alias("counts"), F.lit(0).cast("bigint").alias("total"), F.lit(2**62).cast("bigint").alias("best"))
    return F.aggregate(events, start, slide, lambda state: state["best"])


def _kinds(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[CharacterClass, ...] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and ``secrets``: an array of (start, rank, end, kind), by start and then by the order of the kinds.

    Kinds are the base patterns ``assign``, ``access`` and ``hex`` (the whole match, whatever the allow-list says), then
    those of ``classes``: candidates that touch no base span, hold all that their class needs, have a window of
    :data:`WINDOW` characters with at least ``bits`` of entropy a character, and match no pattern of ``allowed``. Offsets are code points, ends
    exclusive. Null and empty texts have none. Repeated rows come as often as they are there; an empty table gives none.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    # a text is only taken apart where a cheaper test finds something to take apart
    patterns = {"assign": (ASSIGN, text.rlike(ASSIGN_START)), "access": (ACCESS, text.contains("AKIA")), "hex": (HEX, text.rlike(HEX)), "candidates": (CANDIDATE, text.rlike(CANDIDATE))}
    none = F.array().cast("array<string>")
    hits = [F.when(test, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(k) for k, (p, test) in patterns.items()]
    cut = rows.select("doc_id", "text", *hits)
    some = lambda k, c: F.when(F.size(k) > 0, c).otherwise(none)
    cut = cut.select("doc_id", *patterns, some("assign", F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).alias("named"),
                     *[some(k, F.split(text, p, -1)).alias(f"{k}_gaps") for k, (p, _) in patterns.items()])
    found = cut.select("doc_id", "named", *[_spans(F.col(k), F.col(f"{k}_gaps")).alias(k) for k in patterns])
    long_enough = F.filter(F.zip_with("assign", "named", lambda s, name: F.when(F.length(name) >= 12, s)), lambda s: s.isNotNull())
    found = found.withColumn("assign", long_enough).drop("named")
    base = F.concat(*[_kinds(F.col(kind), rank, kind) for rank, kind in enumerate(BASE)])
    found = found.withColumn("base", base)

    def suspicious(c: CharacterClass):
        def test(s: Column) -> Column:
            plausible = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
            for need in c.needs:
                plausible &= s["hit"].rlike(need)
            for pattern in allowed:
                plausible &= ~s["hit"].rlike(pattern)
            return F.when(plausible, _most_random(s["hit"]) <= limit_of(c.bits)).otherwise(False)

        return test

    more = [_kinds(F.filter("candidates", suspicious(c)), len(BASE) + k, c.kind) for k, c in enumerate(classes)]
    return found.select("doc_id", F.array_sort(F.concat("base", *more)).alias("secrets"))


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
