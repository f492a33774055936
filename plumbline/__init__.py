"""Plumbline: evidence-retrieval analytics expressed as Spark DataFrame plans."""
