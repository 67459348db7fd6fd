"""The methods against plain ones: exhaustive search, exact round trips, the library's own tokenizer."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spherecube.llm import decontaminate, html_text, license_scan, near_dup, packing, quality_model, quality_rules, substring_dedup, warc
from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text
from spherecube.llm.queries import QUERIES, table, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver tables")


def prose(rng, n, vocabulary=3000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, words, share):
    return [f"e{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def family_docs(spark):
    """Families of copies with ever more edits, so that some members are linked by way of others only."""
    rng = random.Random(4)
    rows = []
    for _ in range(6):
        base = prose(rng, 120)
        rows += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.08]))) for _ in range(25)]
        rows += [" ".join(base), " ".join(base).upper()]
    rows += [" ".join(prose(rng, rng.randrange(1, 60))) for _ in range(60)] + ["a", "a", "a b", "b a", ""]
    rng.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_exhaustively(family_docs, shingle):
    rows = [(r.doc_id, r.text) for r in family_docs.collect()]
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
        n = min(shingle, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
    component = {i: i for i in sets}

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                component[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(family_docs, shingle=shingle).collect()}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_least_matches():
    assert near_dup.least_matches(64, 1.0) == 64 and 30 < near_dup.least_matches(64, 0.8) < 45


@pytest.mark.parametrize("size", [4096, 32])
def test_lists_give_out_members_rather_than_pairs(spark, monkeypatch, size):
    """A group that collides in several lists comes out once a member, whole or in blocks."""
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", size)
    alike = [[0x0123456789ABCDEF] * 4] * 150 + [[0x1032547698BADCFE] * 4] * 10
    entries = [(token, 0, node, 100, digest) for token in range(6) for node, digest in enumerate(alike)]
    entries += [(9, 0, 150, 100, alike[150]), (9, 0, 500, 70, alike[150]), (9, 0, 501, 100, [0x1111111111111111] * 4)]
    entries = spark.createDataFrame(entries, "token bigint, band bigint, node bigint, n bigint, digest array<bigint>")
    # members 0 to 49 are linked already, 150 and 151 too
    component = spark.createDataFrame([*((k, 0) for k in range(50)), (150, 150), (151, 150)], "node bigint, component bigint")
    rows = near_dup._candidates(entries, component, 64, 40, 80).collect()
    met = {(r.node, r.component) for r in rows}
    assert met == {(k, 0 if k < 50 else 150 if k == 151 else k) for k in range(160)}
    assert len(rows) <= 160 * -(-160 // size)
    root = np.arange(160)
    near_dup._join_roots(root, np.array([r.component for r in rows]), np.array([r.other for r in rows]))
    assert {int(root[c]) for _, c in met} == {0, 150}


def test_compact_windows_exhaustively():
    rng = np.random.default_rng(1)
    for _ in range(20):
        value = rng.integers(0, 9, 60, dtype=np.uint64) << np.uint64(40)
        row = np.sort(rng.integers(0, 3, 60))
        at, left, right = substring_dedup.compact_windows(value, row, 7)
        for i in range(60):
            for j in range(i + 6, 60):
                if row[i] == row[j]:
                    first = i + int(np.argmin(value[i : j + 1]))
                    hit = [k for k in range(len(at)) if left[k] <= i <= at[k] <= j <= right[k]]
                    assert len(hit) == 1 and at[hit[0]] == first


def test_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(8)
    exact, near = prose(rng, 70), prose(rng, 160)
    texts = [prose(rng, 300) for _ in range(40)]
    texts[3][100:100] = exact
    texts[7][20:20] = exact
    texts[21][250:250] = exact
    changed = list(near)
    changed[50], changed[120] = "other", "words"
    texts[5][10:10] = near
    texts[30][200:200] = changed
    texts[33][40:40] = exact[:40]  # too short a repeat
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.start, r.end, r.source_doc_id, r.source_start, r.source_end) for r in substring_dedup.repeated_passages(docs).collect())
    assert got == [(7, 20, 90, 3, 100, 170), (21, 250, 320, 3, 100, 170), (30, 200, 360, 5, 10, 170)]
    cut = {r.doc_id: (r.text.split(), r._cut) for r in substring_dedup.without_passages(docs, substring_dedup.repeated_passages(docs)).collect()}
    assert cut[7] == (texts[7][:20] + texts[7][90:], 70) and cut[3] == (texts[3], 0)


def test_exact_copies_of_what_the_source_quotes_before():
    """A phrase, or parts of the passage, stand elsewhere in the source too."""
    rng = random.Random(5)
    passage = [rng.randrange(1 << 30) for _ in range(70)]
    noise = [rng.randrange(1 << 30) for _ in range(900)]
    for quoted in ([(30, 34)], [(0, 40)], [(40, 70)], [(0, 25), (45, 70)], [(30, 31)] * 40):
        source = list(noise)
        at = 800
        source[at:at] = passage
        for k, (a, b) in enumerate(quoted):
            source[20 + 10 * k : 20 + 10 * k] = passage[a:b]
            at += b - a
        mine = [rng.randrange(1 << 30) for _ in range(100)] + passage + [rng.randrange(1 << 30) for _ in range(100)]
        got = substring_dedup.passages(np.array(mine), np.array(source), [(90, 180)], 46, 0.8)
        assert got == [(100, 169, at, at + 69, 1.0)], quoted
    again = [7] * 3000
    assert substring_dedup.passages(np.array(again), np.array(again), [(0, 2999)], 46, 0.8)


def test_chains_of_runs_exhaustively():
    """Runs follow one another over gaps of up to MAX_GAP in both texts; the longest chain through each, by trying all."""
    rng = np.random.default_rng(4)
    gap = substring_dedup.MAX_GAP
    for n, wide in ((1, 20), (30, 60), (60, 300), (60, 40)):
        x0, y0 = rng.integers(0, wide, n), rng.integers(0, wide, n)
        size = rng.integers(1, 30, n)
        x1, y1 = x0 + size - 1, y0 + size - 1

        def longest(x0, x1, y0, y1):
            best = (x1 - x0 + 1).tolist()
            for k in np.lexsort((y0, x0)).tolist():
                for m in range(len(x0)):
                    near = x1[m] >= x0[k] - gap - 1 and abs(y0[k] - y1[m] - 1) <= gap
                    if near and x0[m] < x0[k] and x1[m] < x1[k] and y0[m] < y0[k] and y1[m] < y1[k]:
                        best[k] = max(best[k], best[m] + x1[k] - max(x1[m], x0[k] - 1))
            return np.array(best)

        want = longest(x0, x1, y0, y1) + longest(-x1, -x0, -y1, -y0) - size
        assert substring_dedup._chained(x0, x1, y0, y1).tolist() == want.tolist()


def test_passages_are_scored_on_sets_of_shingles():
    """Also where shingles repeat within the part, the source, or both."""
    rng = random.Random(9)
    for kind in range(60):
        words = 40 if kind % 2 else 1 << 30
        base = [rng.randrange(words) for _ in range(30)] * 3 if kind % 3 == 0 else [rng.randrange(words) for _ in range(90)]
        copy = [rng.randrange(1 << 30) if rng.random() < 0.02 else w for w in base]
        mine = np.array([rng.randrange(1 << 30) for _ in range(20)] + copy, dtype=np.int32)
        theirs = np.array(base + [rng.randrange(words) for _ in range(50)], dtype=np.int32)
        found = substring_dedup.passages(mine, theirs, [(0, len(mine) - 1)], 46, 0.8)
        assert found
        for first, last, lo, hi, score in found:
            own, other = set(mine[first : last + 1].tolist()), set(theirs[lo : hi + 1].tolist())
            assert score == len(own & other) / len(own | other) >= 0.8 and last - first + 1 >= 46
        for through in (5, 30, 64, 100):
            assert substring_dedup.passages(mine, theirs, [(0, len(mine) - 1)], 46, 0.8, None, through) == [p for p in found if p[0] <= through <= p[1]]


def test_nothing_is_chained_for_parts_between_long_gaps(monkeypatch):
    """Where no stretch between two gaps has room for a passage, repeated shingles aren't paired."""
    rng = np.random.default_rng(7)
    base = np.tile(rng.integers(0, 1 << 30, 60).astype(np.int32), 4)
    mine = base.copy()
    for at in range(44, 240, 58):
        mine[at : at + 13] = rng.integers(0, 1 << 30, 13)
    listed = []
    counterparts = substring_dedup.counterparts
    monkeypatch.setattr(substring_dedup, "counterparts", lambda *a: listed.append(1) or counterparts(*a))
    assert substring_dedup.passages(mine, base, [(0, len(mine) - 1)], 46, 0.8) == [] and not listed
    mine[44:57] = base[44:57]
    assert [p[:2] for p in substring_dedup.passages(mine, base, [(0, len(mine) - 1)], 46, 0.8)] == [(0, 101)] and listed


def test_a_part_is_sorted_once_however_often_it_is_cut(monkeypatch):
    """A part that maps to many places of its source is cut again and again; its sets are counted, not made anew."""
    rng = np.random.default_rng(8)
    theirs = rng.integers(0, 1 << 30, 3000).astype(np.int32)
    mine = np.concatenate([theirs[a : a + 20] for a in range(0, 3000, 200)])
    sorts = []
    for name in ("unique", "argsort"):
        plain = getattr(np, name)
        monkeypatch.setattr(np, name, lambda *a, plain=plain, **k: sorts.append(1) or plain(*a, **k))
    assert substring_dedup.passages(mine, theirs, [(0, len(mine) - 1)], 46, 0.8) == []
    assert len(sorts) <= 3


def test_exact_copies_behind_looser_variants_of_smaller_ids(spark):
    """Variants below the threshold hold the passage's minima, yet the copies among later documents are found."""
    rng = random.Random(12)
    texts, wanted = [], []
    for _ in range(12):
        passage = prose(rng, 60, 10**6)
        for k in range(4):
            # every 15th word is changed: no stretch of 50 words is similar enough
            texts.append(prose(rng, 80, 10**6) + [f"e{rng.randrange(10**9)}" if j % 15 == 3 * k else w for j, w in enumerate(passage)] + prose(rng, 80, 10**6))
        for _ in range(2):
            texts.append(prose(rng, 80, 10**6) + passage + prose(rng, 80, 10**6))
        wanted.append((len(texts) - 1, 80, 140, len(texts) - 2, 80, 140))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {(r.doc_id, r.start, r.end, r.source_doc_id, r.source_start, r.source_end) for r in substring_dedup.repeated_passages(docs).collect()}
    assert set(wanted) <= got


def test_least_shared_against_all_windows():
    rng = np.random.default_rng(3)
    for _ in range(60):
        row = rng.integers(0, rng.integers(2, 40), 30)
        repeats = np.bincount(row)[row]
        through = int(rng.integers(0, 30))
        least = substring_dedup.least_shared(repeats, 12, 0.8, through)
        for a in range(through + 1):
            for b in range(max(a + 12, through + 1), 31):
                assert least <= max(1, -(-8 * len(np.unique(row[a:b])) // 10))


def test_a_repeated_shingle_does_not_let_all_pairs_through(monkeypatch):
    """Stretches that lack a third of each other are ruled out unverified, also where a shingle stands in them often."""
    rng = np.random.default_rng(6)
    base = rng.integers(1 << 20, 1 << 30, 93).astype(np.int32)
    base[-8:] = 7
    rows = []
    for _ in range(40):
        row = base.copy()
        lost = rng.random(93) < 0.33
        lost[[46, *range(85, 93)]] = False
        row[lost] = rng.integers(1 << 20, 1 << 30, lost.sum())
        rows.append(row)
    rows.append(rows[11].copy())
    n = len(rows)
    same = {"key": [5] * n, "i": [0] * n, "j": [0] * n, "start": [0] * n, "at": [46] * n, "block": [0] * n, "open": [True] * n}
    batch = pa.RecordBatch.from_pydict({**same, "doc_id": list(range(n)), "shingles": pa.array([r.tolist() for r in rows], pa.list_(pa.int32()))})
    calls, verify = [], substring_dedup.passages
    monkeypatch.setattr(substring_dedup, "passages", lambda *a: calls.append(1) or verify(*a))
    out = list(substring_dedup._meeting(46, 5, 0.8)(iter([batch])))
    assert [(b.column("doc_id").to_pylist(), b.column("source_doc_id").to_pylist()) for b in out] == [([40], [11])]
    assert len(calls) < 5


def test_decontamination_by_join_equals_by_broadcast(spark):
    rng = random.Random(2)
    items = [prose(rng, n) for n in (3, 9, 10, 14, 40)] + [["w1"]]
    texts = []
    for k in range(60):
        t = prose(rng, rng.randrange(0, 80))
        if k % 3 == 0 and t:
            item = rng.choice(items)
            low = rng.randrange(0, len(item))
            at = rng.randrange(len(t))
            t[at:at] = item[low:] if k % 2 else item
        texts.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id bigint, text string")
    small = {r.doc_id: r._leak for r in decontaminate.annotate(docs, bench).collect()}
    large = {r.doc_id: r._leak for r in decontaminate.annotate(docs, bench, broadcast_windows=0).collect()}
    assert small == large
    for k, text in enumerate(texts):
        words, hit, found = text.split(), set(), set()
        for i, item in enumerate(items):
            n = min(10, len(item))
            windows = {tuple(item[j : j + n]) for j in range(len(item) - n + 1)}
            for j in range(len(words) - n + 1):
                if tuple(words[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found.add(str(i))
        assert (small[k].n_words, small[k].n_hit, small[k].item_ids) == (len(words), len(hit), sorted(found))


def test_first_fit_decreasing():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for k in sorted(range(300), key=lambda k: (-lengths[k], k)):
        b = next((b for b, left in enumerate(room) if left >= lengths[k]), None)
        if b is None:
            b = len(room)
            room.append(100)
        want[k] = (b, 100 - room[b])
        room[b] -= lengths[k]
    assert {k: (int(bins[k]), int(offsets[k])) for k in range(300)} == want


@needs_tables
def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    odd = ["", " ", "\n\n a", "don't  I'll x's", "tab\t\tx \r\n y", "　x　 y", "a  b \u0085 c", "<|endoftext|> <|end", "é ß 中文 🙂🙂 न", "1234 ½ a_b", "\x1c a \x1f"]
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(odd)], "doc_id bigint, text string"))
    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    rows = packing.pack(docs, tokenizer_path()).collect()
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for r in docs.collect():
        assert [i for _, ids in sorted(pieces[r.doc_id]) for i in ids] == tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
    assert sum(r.length for r in rows) >= 0.97 * 1024 * len({r.sequence_id for r in rows})


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = quality_model.Model(np.zeros((0, 7)), 0.3, rng.normal(size=50), rng.normal(size=(50, quality_model.RANK)))
    feature, value = np.array([3, 9, 20, 41, 3]), rng.normal(size=5)
    z, _ = quality_model.margins(m, np.array([0, 0, 0, 0, 1]), feature, value, 2)
    pairs = sum(m.factors[feature[i]] @ m.factors[feature[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert np.isclose(z[0], 0.3 + m.linear[feature[:4]] @ value[:4] + pairs) and np.isclose(z[1], 0.3 + m.linear[3] * value[4])


@needs_tables
@pytest.mark.parametrize("name,label,least", [("op5_quality_classifier", "quality", 0.9), ("op10_toxicity", "toxic", 0.75)])
def test_held_out_ranking(spark, name, label, least):
    sf = SF_DIR.replace("sf0.001", "sf0.01")
    rows = QUERIES[name](spark, sf).filter("held_out").join(table(spark, sf, "labels"), "doc_id").select("score", label).collect()
    right = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in rows if a[label] == 1 for b in rows if b[label] == 0]
    assert sum(right) / len(right) > least


@needs_tables
def test_quality_statistics(spark):
    docs = [r.text for r in table(spark, SF_DIR, "documents").limit(60).collect()] + ["a\na\n\n \nb\na", "x " * 30]
    stats = quality_rules.statistics(tx.Texts(pa.array(docs)))
    for k, text in enumerate(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        seen = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
        if seen is None:
            continue
        repeated = {i + j for i, w in enumerate(windows) if w in seen for j in range(8)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(int(stats[c][k]) for c in quality_rules.BASE) == want


def test_decision_list_learns_a_planted_rule():
    import pandas as pd

    rng = np.random.default_rng(6)
    frame = pd.DataFrame({f: rng.random(900) for f in quality_rules.FEATURES})
    bad = ((frame["bar_ratio"] > 0.8) & (frame["upper_ratio"] <= 0.5)) | (frame["mark_ratio"] > 0.9)
    rules = quality_rules.learn(frame, bad.to_numpy())
    verdict = np.any([r.covers(frame) for r in rules], axis=0)
    assert (verdict == bad).mean() > 0.97


def test_patience_alignment():
    assert license_scan.increasing([3, 1, 2, 5, 4]) == [1, 2, 4]
    rng = random.Random(0)
    for _ in range(100):
        a, b = [rng.randrange(8) for _ in range(20)], [rng.randrange(8) for _ in range(25)]
        pairs = license_scan.align(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_license_with_changed_words(spark):
    rng = random.Random(1)
    words = license_scan.TEMPLATES["BSD-2-Clause"].split()
    for k in range(5, len(words), 17):
        words[k] = "changed"
    text = " ".join(prose(rng, 500) + words + prose(rng, 400) + license_scan.TEMPLATES["ISC"].split())
    docs = spark.createDataFrame([(1, text), (2, " ".join(words[:100]))], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.license, r.coverage > 0.9) for r in license_scan.scan_licenses(docs).collect())
    assert got == [(1, "BSD-2-Clause", True), (1, "ISC", True)]


def test_index_blocks_and_ranges(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, f"http://h{rng.randrange(9)}.example.org/p{rng.randrange(60)}", f"<p>page {rng.randrange(200)} {'x' * 120}</p>") for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = f"file://{tmp_path}/archives"
    captures = warc.write_archives(pages, folder)
    blocks = warc.build_index(captures, block_lines=7)
    assert blocks.agg(F.sum("lines")).first()[0] == 400 and blocks.count() >= 400 // 7
    keys = pages.filter("page_id < 50").select(warc.url_key(F.col("url")).alias("key")).union(spark.createDataFrame([("zz,absent)/",), ("",)], "key string"))
    urls = {r[1] for r in rows[:50]}
    found = warc.read_records(warc.look_up(keys, blocks), folder).collect()
    assert sorted(int(r.page) for r in found) == [k for k, u, _ in rows if u in urls]
    held = {k: (u, h) for k, u, h in rows}
    for r in found:
        url, html = held[int(r.page)]
        assert r.url == url and r.digest == hashlib.sha256(html.encode()).hexdigest() and r.payload == (html.encode() if r.record_type == "response" else b"")


def test_wrapper_alignment():
    w = html_text.Wrapper()
    one = w.add([(-1, ""), (0, "nav"), (0, "div"), (2, "p")])
    two = w.add([(-1, ""), (0, "nav"), (0, "aside"), (0, "div"), (3, "h1"), (3, "p")])
    assert two[1] == one[1] and two[3] == one[2] and two[5] == one[3] and len(w.labels) == 6


@needs_tables
def test_pages_against_their_article_elements(spark):
    from html import unescape

    got = {r.page_id: r.text for r in QUERIES["op9_html_extraction"](spark, SF_DIR).collect()}
    for r in table(spark, SF_DIR, "pages").collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", body))
        assert got[r.page_id] == " ".join(unescape(plain).split())


@needs_tables
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SF_DIR, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == docs.columns, name
        rows = {r.doc_id: r.text for r in after.collect()}
        assert set(rows) <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "quality rules":
            kept = {r.doc_id for r in QUERIES["op3_quality_rules"](spark, SF_DIR).filter("kept").collect()}
            assert set(rows) == kept
        if name == "near-duplicates":
            found = near_dup.near_duplicates(before)
            assert set(rows) == {r.doc_id for r in found.filter("kept").collect()}
        if name == "benchmark decontamination":
            items = id_and_text(table(spark, SF_DIR, "benchmark"), "item_id").collect()
            low = [" ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) for t in rows.values()]
            windows = set()
            for r in items:
                words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.lower())
                n = min(10, len(words))
                windows |= {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)}
            assert not any(f" {w} " in f" {t} " for t in low for w in windows if len(w) > 20)
        before = spark.createDataFrame(after.toPandas(), docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}
