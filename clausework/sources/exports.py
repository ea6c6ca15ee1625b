"""JSON for interchange and a page to look at; tables are written by their executors, never gathered."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Ontology


def records_json(records: DataFrame, path: str) -> None:
    """Entities or relations as JSON lines, with from and to as relations' ends."""
    for a, b in (("src", "from"), ("dst", "to")):
        records = records.withColumnRenamed(a, b) if a in records.columns else records
    records.drop("ord").write.mode("overwrite").json(path)


def result_json(rows: DataFrame, path: str) -> None:
    """Any result table as JSON lines."""
    rows.write.mode("overwrite").json(path)


def ontology_json(ontology: Ontology | None = None) -> str:
    """The schema for a viewer, without what only checks need."""
    o = ontology or Ontology()
    return json.dumps({"entity_types": {n: {"subtype_of": p} for n, p in o.entity_types}, "relation_types": {n: {"domain": list(d), "range": list(r)} for n, d, r in o.relation_types}}, indent=1)


def view_page(nodes: DataFrame, edges: DataFrame, title: str, most: int = 2000) -> str:
    """A page listing a graph view for reading; a view of more than ``most`` rows is to be focused first."""
    n, e = nodes.orderBy("id").limit(most + 1).collect(), edges.orderBy("id").limit(most + 1).collect()
    if max(len(n), len(e)) > most:
        raise ValueError(f"the view has more than {most} nodes or edges; focus it first")
    rows = "".join(f"<tr id='{html.escape(x.id)}'><td>{html.escape(x.grp)}</td><td>{html.escape(x.label or '')}</td><td>{html.escape(x.detail or '')}</td></tr>" for x in n)
    links = "".join(f"<tr><td><a href='#{html.escape(x.src)}'>{html.escape(x.src)}</a></td><td>{html.escape(x.label)}</td><td><a href='#{html.escape(x.dst)}'>{html.escape(x.dst)}</a></td></tr>" for x in e)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table>{rows}</table><table>{links}</table>"


def _held(rows: DataFrame, order: tuple[str, ...], most: int, what: str) -> list:
    held = rows.orderBy(*order).limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} {what}; choose some of them first")
    return held


def concept_page(tree: DataFrame, title: str, most: int = 500) -> str:
    """A page of a concept tree (``panels.concept_tree``): nested by ``broader``, with numbers and first members."""
    rows = _held(tree, ("ord", "id") if "ord" in tree.columns else ("depth", "id"), most, "concepts")
    known, below = {r.id for r in rows}, {}
    for r in rows:
        below.setdefault(r.broader if r.broader in known else None, []).append(r)
    more = lambda shown, n: [*map(html.escape, shown), *([f"and {n - len(shown)} more"] if n > len(shown) else [])]
    done, lines = set(), []
    todo: list = [("open", r) for r in reversed(below.get(None, []))]
    rest = [r for r in rows if r.broader in known]
    while todo or rest:
        if not todo:  # what only a cycle leads to stands by itself
            first = rest.pop(0)
            todo = [] if first.id in done else [("open", first)]
            continue
        kind, r = todo.pop()
        if kind == "close":
            lines.append("</ul></li>")
        elif r.id not in done:
            done.add(r.id)
            aside = "" if r.in_scope else " class='aside'"
            lines.append(f"<li id='{html.escape(r.id)}'{aside}><b>{html.escape(r.label or r.id)}</b> ({r.n}) <i>{html.escape(r.type)}</i><p>{' &larr; '.join(map(html.escape, r.chain or []))}</p>")
            lines.append(f"<p>{', '.join(more(r.members, r.n))}</p><ul>")
            todo += [("close", r), *(("open", x) for x in reversed(below.get(r.id, [])))]
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><style>.aside{{opacity:.5}}</style><ul>{''.join(lines)}</ul>"


def facts_page(marked: DataFrame, facts: DataFrame, title: str, most: int = 500, most_facts: int = 10_000) -> str:
    """A page of clauses (``panels.marked_texts``) with their facts (``panels.clause_facts``), each linked to its mark."""
    of: dict[str, list] = {}
    for f in _held(facts, ("key", "pos"), most_facts, "facts"):
        of.setdefault(f.key, []).append(f)
    lines = []
    for c in _held(marked, ("key",), most, "clauses"):
        key = html.escape(c.key)
        body = "".join(html.escape(p.text) if p.pos is None else f"<mark id='{key}:{p.pos}'>{html.escape(p.text)}</mark>" for p in c.parts)
        named = lambda f: f"{html.escape(f.src_label)} <b>{html.escape(f.type)}</b> {html.escape(f.dst_label)}"
        items = "".join(f"<li>{named(f)}</li>" if f.start is None else f"<li><a href='#{key}:{f.pos}'>{named(f)}</a></li>" for f in of.get(c.key, []))
        lines.append(f"<section id='{key}'><h2>{key} {html.escape(c.title or '')}</h2><pre>{body}</pre><ul>{items}</ul></section>")
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title>{''.join(lines)}"


def shareable(records: DataFrame, columns: tuple[str, ...] = ("id", "type", "label")) -> DataFrame:
    """Ids, types and shortened labels alone."""
    from ..functions.text import truncated

    return records.select(*[truncated(F.col(c)).alias(c) if c == "label" else F.col(c) for c in columns])
