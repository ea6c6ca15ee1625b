"""The questions that a protocol graph is read for, as joins of relations and entities. Each answers for the whole graph.

entities (id, type, label, defined_in), relations (ord, type, src, dst, attrs). An end that names no entity keeps its id and
has a null label. No question pairs the members of a group with each other: what many share is counted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import checkpointed, maybe_broadcast

# fixed values: names of relation types
EXCHANGES, CONTAINS, REUSED_BY = "EXCHANGES", "CONTAINS", "REUSED_BY"
STARTS, GOVERNS, ON_EXPIRY_OF = "STARTS", "GOVERNS", "ON_EXPIRY_OF"
HAS_PRECONDITION, TRANSITIONS_TO, TRIGGERS = "HAS_PRECONDITION", "TRANSITIONS_TO", "TRIGGERS"
INVOKES, ON_FAILURE_INVOKES = "INVOKES", "ON_FAILURE_INVOKES"


def _labelled(rows: DataFrame, entities: DataFrame, end: str, name: str = "label") -> DataFrame:
    return rows.join(entities.select(F.col("id").alias(end), F.col("label").alias(name)), end, "left")


def _true(value: Column) -> Column:
    return F.coalesce(F.lower(value).isin("true", "yes", "1"), F.lit(False))


def messages(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(procedure, message, label, direction): what a procedure exchanges, and which way."""
    rows = relations.where(F.col("type") == EXCHANGES).select(F.col("src").alias("procedure"), F.col("dst").alias("message"), F.col("attrs")["direction"].alias("direction"))
    return _labelled(rows, entities, "message").select("procedure", "message", "label", "direction")


def timers(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(procedure, timer, label, how, expiry): timers that a procedure starts or that govern it, with the event of their expiry."""
    kind = F.col("type")
    starts = relations.where(kind == STARTS).select(F.col("src").alias("procedure"), F.col("dst").alias("timer"), F.lit("starts").alias("how"))
    governs = relations.where(kind == GOVERNS).select(F.col("dst").alias("procedure"), F.col("src").alias("timer"), F.lit("governs").alias("how"))
    expiry = relations.where(kind == ON_EXPIRY_OF).groupBy(F.col("dst").alias("timer")).agg(F.min_by("src", F.struct("ord", "src")).alias("expiry"))
    rows = _labelled(starts.unionByName(governs), entities, "timer").join(expiry, "timer", "left")
    return rows.select("procedure", "timer", "label", "how", "expiry")


def states(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(procedure, before, after): labels of the first state that must hold and of the last that is entered; other conditions are no states.

    A few states may end most relations, so the states are counted and broadcast: no task gets all relations of one state.
    """
    known = checkpointed(entities.where("type = 'State'").select(F.col("id").alias("dst"), "label"))
    known = maybe_broadcast(known, known.count(), 256)
    rows = relations.where(F.col("type").isin(HAS_PRECONDITION, TRANSITIONS_TO)).join(known, "dst")
    of = lambda kind, pick: pick(F.when(F.col("type") == kind, F.col("label")), F.when(F.col("type") == kind, F.struct("ord", "dst")))
    return rows.groupBy(F.col("src").alias("procedure")).agg(of(HAS_PRECONDITION, F.min_by).alias("before"), of(TRANSITIONS_TO, F.max_by).alias("after"))


def elements(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(message, element, label, optional): what a message carries."""
    rows = relations.where(F.col("type") == CONTAINS).select(F.col("src").alias("message"), F.col("dst").alias("element"), _true(F.col("attrs")["optional"]).alias("optional"))
    return _labelled(rows, entities, "element").select("message", "element", "label", "optional")


def invoked(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(procedure, label, invoked, on_failure) of every procedure; invoked is null for those that invoke none."""
    edges = relations.where(F.col("type").isin(INVOKES, ON_FAILURE_INVOKES))
    edges = edges.select(F.col("src").alias("procedure"), F.col("dst").alias("invoked"), (F.col("type") == ON_FAILURE_INVOKES).alias("on_failure"))
    return entities.where("type = 'Procedure'").select(F.col("id").alias("procedure"), "label").join(edges, "procedure", "left")


def reuse(relations: DataFrame) -> DataFrame:
    """(message, procedures): how many procedures exchange or reuse each message that more than one does."""
    kind = F.col("type")
    own = relations.where(kind == EXCHANGES).select(F.col("dst").alias("message"), F.col("src").alias("procedure"))
    others = relations.where(kind == REUSED_BY).select(F.col("src").alias("message"), F.col("dst").alias("procedure"))
    pairs = own.unionByName(others).distinct()  # so that a frequent message is counted in parts
    return pairs.groupBy("message").agg(F.count(F.lit(1)).alias("procedures")).where("procedures > 1")


def triggers(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(procedure, label, role, cause, cause_label): what triggers a procedure, and what must hold before it."""
    kind = F.col("type")
    by = relations.where(kind == TRIGGERS).select(F.col("dst").alias("procedure"), F.lit("trigger").alias("role"), F.col("src").alias("cause"))
    held = relations.where(kind == HAS_PRECONDITION).select(F.col("src").alias("procedure"), F.lit("precondition").alias("role"), F.col("dst").alias("cause"))
    rows = _labelled(_labelled(by.unionByName(held), entities, "procedure"), entities, "cause", "cause_label")
    return rows.select("procedure", "label", "role", "cause", "cause_label")


def definitions(rows: DataFrame, lineage: str = "defined_in") -> DataFrame:
    """(id, spec, release, clause): every place where an entity, or by its provenance a relation, is defined, each once."""
    return rows.select("id", F.explode(lineage).alias("p")).select("id", "p.spec", "p.release", "p.clause").distinct()
