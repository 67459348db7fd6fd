"""spherecube: gridded climate and weather cubes on the sphere, as Spark DataFrames."""

__version__ = "0.1.0"
