"""tessera — relational, dimensional, document, graph and layered-pipeline
operators expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
