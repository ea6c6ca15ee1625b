"""Logical tables and the vocabulary they use, as data: types, relations, releases, specifications."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = "doc_id string, ord int, kind string, style string, level int, text string"
CLAUSES = "spec string, version string, ord int, key string, number string, title string, level int, parent string, text string, tables int"
PROV = "struct<release:string,spec:string,version:string,clause:string,anchor:string,curated:boolean,external:boolean>"
LIFE = "observed_in array<string>, introduced_in string, valid_until string, supersedes string"
ENTITIES = f"ord long, id string, type string, label string, extractor string, confidence string, review string, defined_in array<{PROV}>, {LIFE}"
RELATIONS = f"ord long, id string, type string, src string, dst string, modality string, confidence string, procedure_ctx string, attrs map<string,string>, extractor string, provenance array<{PROV}>, {LIFE}"
FINDINGS = "rule_ord int, row_ord long, cat string, id string, rel string, slot string, ref string, got string, allowed string"
REVIEW = "section int, pos long, sub int, kind string, id string, type string, src string, reason string, detail string, distance double"

#: Ordered releases.
RELEASES = ("Rel-15", "Rel-16", "Rel-17", "Rel-18", "Rel-19", "Rel-20")
#: Entity types and their parents.
ENTITY_TYPES = {
    "Entity": None, "DomainRoot": "Entity", "Stratum": "Entity", "ProtocolLayer": "Entity", "Procedure": "Entity", "Message": "Entity",
    "InformationElement": "Entity", "Timer": "Entity", "State": "Entity", "Event": "Entity", "Condition": "Entity", "Capability": "Entity",
    "Bearer": "Entity", "UEVariable": "Entity", "Release": "Entity", "SIPMethod": "Message", "SIPResponse": "Message",
    "SIPHeader": "InformationElement", "Identity": "InformationElement", "NetworkElement": "Entity",
}
_DOMAIN = ("Procedure", "Message", "InformationElement", "Timer", "State", "Event", "Condition", "Capability", "Bearer", "UEVariable", "SIPMethod", "SIPResponse", "SIPHeader", "Identity", "NetworkElement")
#: Relation types with the types that each end allows (* allows all).
RELATION_TYPES = {
    "DEFINED_IN": (("*",), ("Clause",)),
    "CONTAINS": (("Message", "InformationElement"), ("InformationElement",)),
    "HAS_DOMAIN": (("InformationElement",), ("InformationElement", "Capability")),
    "EXCHANGES": (("Procedure",), ("Message",)),
    "REUSED_BY": (("Message",), ("Procedure",)),
    "STARTS": (("Procedure",), ("Timer",)),
    "STOPS": (("Procedure",), ("Timer",)),
    "TRANSITIONS_TO": (("Procedure",), ("State",)),
    "HAS_PRECONDITION": (("Procedure",), ("State", "Condition")),
    "TRIGGERS": (("Event",), ("Procedure",)),
    "RAISES": (("Procedure",), ("Event",)),
    "ALTERNATIVE_OUTCOME": (("Procedure",), ("Message",)),
    "ESTABLISHES": (("Procedure",), ("Bearer",)),
    "INVOKES": (("Procedure",), ("Procedure",)),
    "ON_EXPIRY_OF": (("Event",), ("Timer",)),
    "CONFIGURES": (("InformationElement",), ("Timer",)),
    "GOVERNS": (("Timer",), ("Procedure",)),
    "READS": (("Procedure",), ("UEVariable", "InformationElement")),
    "WRITES": (("Procedure",), ("UEVariable", "InformationElement")),
    "ACTS_ON": (("Procedure",), ("ProtocolLayer",)),
    "ON_FAILURE_INVOKES": (("Procedure",), ("Procedure",)),
    "INTERACTS_WITH": (("Procedure",), ("NetworkElement",)),
    "IDENTIFIED_BY": (("Procedure", "Message"), ("Identity",)),
    "IN_LAYER": (_DOMAIN, ("ProtocolLayer",)),
    "BROADER": (("ProtocolLayer", "Stratum"), ("Stratum", "DomainRoot")),
    "NEXT_RELEASE": (("Release",), ("Release",)),
    "SUPERSEDES": (("*",), ("*",)),
}
#: Relation types whose subject has one object.
FUNCTIONAL = ("HAS_DOMAIN", "ON_EXPIRY_OF", "GOVERNS")
#: Retyping rules (relation, type of its source, type of its target, new relation).
RETYPE_RULES = (("TRIGGERS", "Procedure", "Event", "RAISES"),)


def _ancestors(parents: dict[str, str | None], name: str) -> list[str]:
    out: list[str] = []
    at: str | None = name
    while at is not None and at not in out:
        out.append(at)
        at = parents.get(at)
    return out


def type_closure(types: DataFrame) -> DataFrame:
    """(type, ancestor) of a table of types (type, subtype_of) of any size, each type its own ancestor."""
    from .operators.graphs import ancestors

    found = ancestors(types.select(F.col("type").alias("node"), F.col("subtype_of").alias("parent")))
    return found.select(F.col("node").alias("type"), "ancestor")


@dataclass(frozen=True)
class Ontology:
    """Types as data; users extend it by rows. ``tables`` gives it as DataFrames of a few hundred rows at most."""

    entity_types: tuple[tuple[str, str | None], ...] = tuple(ENTITY_TYPES.items())
    relation_types: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = tuple((n, d, r) for n, (d, r) in RELATION_TYPES.items())
    functional: tuple[str, ...] = FUNCTIONAL
    releases: tuple[str, ...] = RELEASES

    def pseudo_types(self) -> set[str]:
        """Types that a slot names and nobody declares."""
        declared = {n for n, _ in self.entity_types}
        return {t for _, d, r in self.relation_types for t in (*d, *r) if t != "*" and t not in declared}

    def types(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.entity_types), "type string, subtype_of string")

    def closure(self, spark: SparkSession) -> DataFrame:
        """(type, ancestor), each type its own ancestor."""
        parents = dict(self.entity_types)
        return spark.createDataFrame([(t, a) for t in parents for a in _ancestors(parents, t)], "type string, ancestor string")

    def relations(self, spark: SparkSession) -> DataFrame:
        pseudo = self.pseudo_types()
        only = lambda s: bool(s) and set(s) <= pseudo
        rows = [(n, n in self.functional, str(list(d)), str(list(r)), only(d), only(r)) for n, d, r in self.relation_types]
        return spark.createDataFrame(rows, "rel string, functional boolean, domain string, range string, pseudo_src boolean, pseudo_dst boolean")

    def allowed(self, spark: SparkSession) -> DataFrame:
        """(rel, slot, type): every type that a slot accepts, subtypes included, ``*`` expanded to all declared ones."""
        parents = dict(self.entity_types)
        rows = set()
        for n, d, r in self.relation_types:
            for slot, accepted in (("src", d), ("dst", r)):
                rows |= {(n, slot, t) for t in parents if "*" in accepted or set(_ancestors(parents, t)) & set(accepted)}
        return spark.createDataFrame(sorted(rows), "rel string, slot string, type string")

    def wildcards(self, spark: SparkSession) -> DataFrame:
        """(rel, slot) that accept anything, undeclared types too."""
        rows = [(n, s) for n, d, r in self.relation_types for s, a in (("src", d), ("dst", r)) if "*" in a]
        return spark.createDataFrame(rows, "rel string, slot string")

    def compatible(self, spark: SparkSession) -> DataFrame:
        """(a, b): equal types, or one an ancestor of the other."""
        c = self.closure(spark)
        return c.select(F.col("type").alias("a"), F.col("ancestor").alias("b")).union(c.select("ancestor", "type")).distinct()


@dataclass(frozen=True)
class SpecConfig:
    """What selects and types a specification's clauses. Terms and vocabulary are the user's data."""

    spec: str
    version: str = ""
    include_prefixes: tuple[str, ...] = ()
    drop_prefixes: tuple[str, ...] = ()
    actor_terms: tuple[str, ...] = ()
    other_terms: tuple[str, ...] = ()
    vocab: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def compact(self) -> str:
        return self.spec.replace("TS ", "").replace(".", "")

    @property
    def store_name(self) -> str:
        return f"{self.compact}-{self.version}"

    @property
    def release(self) -> str:
        return f"Rel-{int(self.version.split('.')[0])}"


class Registry:
    """Templates by specification."""

    def __init__(self, *templates: SpecConfig):
        self.templates = {t.spec: t for t in templates}

    def get(self, spec: str, version: str) -> SpecConfig:
        if spec not in self.templates:
            raise KeyError(f"no template for {spec!r}; known: {', '.join(sorted(self.templates)) or 'none'}")
        return replace(self.templates[spec], version=version)


@dataclass(frozen=True)
class Options:
    """Settings with one order of precedence: an explicit value, a Spark setting ``clausework.<name>``, the default.

    A setting that does not parse counts as unset.
    """

    rho: float = 0.18
    max_clause_chars: int = 6000
    retries: int = 3
    batch_size: int = 32
    sentinel: bool = False
    prompt_variant: str = "v1"

    @classmethod
    def of(cls, spark: SparkSession, **explicit) -> Options:
        values = {}
        for name, default in ((f, getattr(cls, f)) for f in cls.__dataclass_fields__):
            raw = spark.conf.get(f"clausework.{name}", None)
            if explicit.get(name) is not None:
                values[name] = explicit[name]
            elif raw is not None:
                try:
                    values[name] = raw.strip().lower() in ("1", "true", "yes", "on") if isinstance(default, bool) else type(default)(raw)
                except ValueError:
                    pass
        return cls(**values)
