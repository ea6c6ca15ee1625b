"""Relational, graph and text operators over blocks, clauses, entities, relations and provenance."""
