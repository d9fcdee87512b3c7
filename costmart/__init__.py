"""costmart: a clinical cost data mart and its queries, written as Spark
DataFrame / SQL plans (see README.md)."""

__version__ = "0.1.0"
