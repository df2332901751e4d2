"""Table functions: one value in, rows out; for LATERAL in SQL and DataFrame.lateralJoin."""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


#: Properties that hold a node's own texts.
_TEXTS = ("id", "type", "content", "_label", "label", "assigned_property")


def _listed(x) -> list:
    return [] if x is None else x if isinstance(x, list) else [x]


def _text(x) -> str | None:
    """A JSON value as text; a list's values are joined by blanks."""
    if x is None or isinstance(x, dict):
        return None
    return " ".join(str(v) for v in x) if isinstance(x, list) else str(x)


def _ids(x) -> list[str]:
    """Ids of nodes that are named by objects or by plain texts."""
    return [i for i in ((v.get("id") or "") if isinstance(v, dict) else v if isinstance(v, str) else "" for v in _listed(x)) if i]


@udtf(returnType="node int, parent int, path string, ancestors array<int>, type string, id string, content string, label string, assigned_property string, languages array<string>, inherited array<string>, kinds array<string>, spans map<string,string>")
class LdNodes:
    """The nodes of one JSON-LD document in document order, the root as node 0 with an empty path.

    path: the properties that lead there, joined by '/'; lists add nothing, a plain text in a list, or a URI, is a node with that id
    and null spans, but for the texts of a node itself. languages and kinds: ids under `language` and `classified_as`; inherited: languages
    of the node or the nearest above it, short of the root, that has any. spans: plain texts among the node's other properties. No rows for null, broken
    JSON and documents that are no object; nesting of any depth that the JSON reader takes.
    """

    def eval(self, doc: str) -> Iterator[tuple]:
        try:
            root = json.loads(doc) if doc else None
        except (ValueError, RecursionError):
            return
        if not isinstance(root, dict):
            return
        n, stack = 0, [(root, None, "", [], None)]
        while stack:
            value, parent, path, above, inherited = stack.pop()
            node, n = n, n + 1
            if isinstance(value, str):
                yield node, parent, path, above, None, value, None, None, None, [], inherited or [], [], None
                continue
            languages = _ids(value.get("language"))
            spoken = languages if value.get("language") else inherited
            spans = {k: v for k, v in value.items() if isinstance(v, str) and k not in ("id", "type", "content", "_label", "label", "language", "classified_as")}
            label = value.get("_label") or value.get("label")
            yield node, parent, path, above, _text(value.get("type")), _text(value.get("id")) or None, _text(value.get("content")), _text(label), _text(value.get("assigned_property")), languages, spoken or [], _ids(value.get("classified_as")), spans
            below = [(v, node, f"{path}/{k}" if path else k, [*above, node], spoken if parent is not None else None) for k, x in value.items() if k != "language" for v in _listed(x) if isinstance(v, dict) or (isinstance(v, str) and k not in _TEXTS and (isinstance(x, list) or "://" in v))]
            stack.extend(reversed(below))


@udtf(returnType="node int, parent int, depth int, tag string, attributes map<string,string>, text string")
class XmlTree:
    """The elements of one XML document in document order with their depth; tags without name space. No rows for null and broken XML."""

    def eval(self, xml: str) -> Iterator[tuple]:
        try:
            root = ET.fromstring(xml) if xml else None
        except ET.ParseError:
            return
        if root is None:
            return
        plain = lambda name: name.rsplit("}", 1)[-1]
        n, stack = 0, [(root, None, 0)]
        while stack:
            e, parent, depth = stack.pop()
            node, n = n, n + 1
            yield node, parent, depth, plain(e.tag), {plain(k): v for k, v in e.attrib.items()}, (e.text or "").strip() or None
            stack.extend((c, node, depth + 1) for c in reversed(list(e)))


@udtf(returnType="position int, member string, numbers array<double>")
class TemplateMembers:
    """The members of one solved template, as JSON text: a list of texts, or of objects with raw and numbers. Others are passed over."""

    def eval(self, members: str) -> Iterator[tuple]:
        try:
            found = json.loads(members) if members else []
        except ValueError:
            return
        for i, m in enumerate(_listed(found)):
            if isinstance(m, str):
                yield i, m, None
            elif isinstance(m, dict) and isinstance(m.get("raw"), str):
                numbers = [float(x) for x in _listed(m.get("numbers")) if isinstance(x, (int, float)) and not isinstance(x, bool)]
                yield i, m["raw"], numbers


TABLE_FUNCTIONS = {"ld_nodes": LdNodes, "xml_tree": XmlTree, "template_members": TemplateMembers}


def register(spark: SparkSession) -> None:
    """Make the table functions known to SQL."""
    for name, fn in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, fn)
