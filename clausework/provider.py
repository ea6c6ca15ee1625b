"""Model replies and vectors from a pluggable function, inside tasks: retries, back-off, one re-ask, shrinking batches."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .errors import EngineError, packed
from .functions.kernels import FACTS, chunk, parse_reply, read_reply, without_reasoning
from .functions.text import strip_reasoning
from .schema import Ontology, SpecConfig

#: Seconds before the first retry, and the most before any.
FIRST_WAIT, LONGEST_WAIT = 2.0, 30.0
#: What a model writes between its reasoning and its answer, where it is asked to.
SENTINEL = "=== ANSWER ==="
REMINDER = "That was no JSON array. Answer with the JSON array of facts alone, or [] if there are none."
#: A provider takes a list of messages (role, content) and returns the reply.
Provider = Callable[[list[dict]], str]


def wait_before(attempt: int) -> float:
    """Seconds before retry number ``attempt`` (from 1): doubling, up to the longest."""
    return min(LONGEST_WAIT, FIRST_WAIT * 2 ** (attempt - 1))


def with_retries(call: Callable[[], str], retries: int, sleep: Callable[[float], None] = time.sleep) -> str:
    attempt = 0
    while True:
        try:
            return call()
        except EngineError as e:
            attempt += 1
            if attempt > retries or not e.transient():
                raise
            sleep(wait_before(attempt))


def in_batches(items: list, call: Callable[[list], list], size: int) -> list:
    """Results in order, from batches of at most ``size``; a batch that is too large (status 413) is halved, for good."""
    out: list = []
    while len(out) < len(items):
        try:
            out += call(items[len(out) : len(out) + size])
        except EngineError as e:
            if e.context.get("status") != 413 or size == 1:
                raise
            size = max(1, min(size, len(items) - len(out)) // 2)
    return out


def ontology_card(ontology: Ontology | None = None) -> str:
    """The vocabulary in words, for a prompt."""
    o = ontology or Ontology()
    types = "\n".join(f"- {n}" + (f" (a {p})" if p else "") for n, p in o.entity_types)
    relations = "\n".join(f"- {n}: {' | '.join(d)} -> {' | '.join(r)}" for n, d, r in o.relation_types)
    return f"Entity types:\n{types}\nRelations:\n{relations}"


def messages(cfg: SpecConfig, key: str, title: str, text: str, examples: list[dict] = (), variant: str = "v1", ontology: Ontology | None = None, sentinel: bool = False) -> list[dict]:
    """The request for one chunk of a clause; examples are (clause, text, facts)."""
    rule = "Name only facts that the text states; quote the span that states each as its anchor." if variant == "v2" else "Name the facts of the text."
    marked = f" Write the line {SENTINEL} after your reasoning and the array behind it." if sentinel else ""
    system = f"You read {cfg.spec} and answer with a JSON array of facts. {rule}{marked}\n{ontology_card(ontology)}"
    shown = "".join(f"\nExample {e['clause']}:\n{e['text']}\nFacts: {json.dumps(e.get('facts') or [], ensure_ascii=False)}\n" for e in examples)
    return [{"role": "system", "content": system}, {"role": "user", "content": f"{shown}\nClause {key} {title}\n{text}"}]


def ask(provider: Provider, request: list[dict], retries: int, readable: Callable[[str], bool]) -> str:
    """The reply; asked once more if it says something that does not parse."""
    reply = with_retries(lambda: provider(request), retries)
    if reply.strip() and not readable(reply):
        again = [*request, {"role": "assistant", "content": reply}, {"role": "user", "content": REMINDER}]
        reply = with_retries(lambda: provider(again), retries)
    return reply


def replies(clauses: DataFrame, cfg: SpecConfig, provider: Provider, max_chars: int = 6000, retries: int = 3, variant: str = "v1", parallel: int | None = None, examples: list[dict] = (), ontology: Ontology | None = None, sentinel: bool = False, keep_errors: bool = False) -> DataFrame:
    """(clause_ord, clause, part, reply) for every chunk of the clauses' texts. Examples are few, and part of every request.

    With keep_errors also error: a request that fails is a row with its error, and its task asks nothing more; what it leaves
    out has no row. Without, a failure fails the job.
    """

    def readable(reply: str) -> bool:
        answer = reply.rpartition(SENTINEL)[2] if sentinel else reply
        return read_reply(without_reasoning(answer))[1] is not None

    def asked(key: str, title: str, text: str) -> Iterator[tuple[int, str | None, str | None]]:
        for part, piece in enumerate(chunk(text or "", max_chars)):
            try:
                yield part, ask(provider, messages(cfg, key, title or "", piece, examples, variant, ontology, sentinel), retries, readable), None
            except Exception as e:
                if not keep_errors:
                    raise
                yield part, None, packed(e)
                return

    columns = ["clause_ord", "clause", "part", "reply", *(["error"] if keep_errors else [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = False
        for frame in frames:
            rows = []
            for at, key, title, text in zip(frame["ord"], frame["key"], frame["title"], frame["text"], strict=True):
                if failed:
                    break
                rows += [(at, key, part, reply, error) for part, reply, error in asked(key, title, text)]
                failed = rows[-1][-1] is not None if rows else False
            yield pd.DataFrame([r[: len(columns)] for r in rows], columns=columns)

    rows = clauses.select(F.col("ord").cast("long").alias("ord"), "key", "title", "text")
    rows = rows.repartition(parallel, "key") if parallel else rows
    return rows.mapInPandas(run, "clause_ord long, clause string, part int, reply string" + (", error string" if keep_errors else ""))


def facts_of(replied: DataFrame, marker: str | None = None) -> DataFrame:
    """(clause_ord, clause, facts): each clause's facts over all its parts, in order; empty where nothing parses. If replies
    carry errors, also error: one of the clause's, null where all its requests were answered."""
    parsed = replied.withColumn("r", parse_reply(strip_reasoning(F.col("reply"), marker)))
    errors = [F.min("error").alias("error")] if "error" in replied.columns else []
    parts = parsed.groupBy("clause_ord", "clause").agg(F.array_sort(F.collect_list(F.struct("part", F.coalesce("r.facts", F.array().cast(FACTS)).alias("facts")))).alias("p"), *errors)
    return parts.select("clause_ord", "clause", F.flatten("p.facts").alias("facts"), *(["error"] if errors else []))


def vectors_of(labels: DataFrame, embed: Callable[[list[str]], list[list[float]]], size: int = 32, retries: int = 3) -> DataFrame:
    """(label, vector) of distinct labels, asked for in batches inside tasks; a batch that is too large is halved."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = frame["label"].tolist()
            got = in_batches(names, lambda part: with_retries(lambda: embed(part), retries), size)
            yield pd.DataFrame({"label": names, "vector": [[float(x) for x in v] for v in got]})

    return labels.select("label").where("label is not null").distinct().mapInPandas(run, "label string, vector array<double>")
