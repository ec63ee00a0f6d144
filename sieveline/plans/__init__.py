"""Composed pipelines, reports, the model boundary and the registered queries."""
