"""Turtle text as rows of a graph, and a graph as Turtle, N-Triples or RDF/XML text."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ternion.plans.sparql.parser import unescape
from ternion.schema import PREFIXES, RDF, RDF_TYPE, XSD

_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)|(?P<iri><[^<>"{}|^`\s]*>)|(?P<str>\"\"\"(?:[^\\]|\\.)*?\"\"\"|'''(?:[^\\]|\\.)*?'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<at>@[A-Za-z]+(?:-[\w]+)*)|(?P<num>[+-]?(?:\d+\.\d+(?:[eE][+-]?\d+)?|\.\d+|\d+[eE][+-]?\d+|\d+))|(?P<bnode>_:[\w-]+)
    |(?P<pname>(?:[A-Za-z][\w.-]*)?:(?:[\w%](?:[\w.%/-]*[\w%-])?)?)|(?P<word>[A-Za-z]+)|(?P<op>\^\^|[\[\]().;,])""",
    re.X | re.S,
)


def parse_turtle(text: str, scope: str = "") -> Iterator[tuple[str, str, str, str, str, str]]:
    """Rows (s, p, o, o_kind, datatype, lang). Blank labels start with ``_:`` and carry ``scope``."""
    tokens: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"Turtle syntax error at {text[at : at + 30]!r}")
        if m.lastgroup != "skip":
            tokens.append((m.lastgroup, m[0]))
        at = m.end()
    prefixes: dict[str, str] = {}
    base, i, blanks = "", 0, 0
    rows: list[tuple[str, str, str, str, str, str]] = []

    def is_op(value: str) -> bool:
        return i < len(tokens) and tokens[i] == ("op", value)

    def fresh() -> str:
        nonlocal blanks
        blanks += 1
        return f"_:{scope}b{blanks}"

    def iri() -> str:
        nonlocal i
        kind, value = tokens[i]
        i += 1
        if kind == "iri":
            body = unescape(value[1:-1])
            return body if ":" in body else base + body
        if kind == "pname":
            prefix, local = value.split(":", 1)
            return prefixes[prefix] + local
        if (kind, value) == ("word", "a"):
            return RDF_TYPE
        raise ValueError(f"expected an IRI, found {value!r}")

    def term() -> tuple[str, str, str, str]:
        nonlocal i
        kind, value = tokens[i]
        if kind == "op" and value == "[":
            i += 1
            me = fresh()
            if not is_op("]"):
                properties(me)
            i += 1
            return me, "bnode", "", ""
        if kind == "op" and value == "(":
            i += 1
            items = []
            while not is_op(")"):
                items.append(term())
            i += 1
            head: tuple[str, str, str, str] = (RDF + "nil", "iri", "", "")
            for item in reversed(items):
                me = fresh()
                rows.append((me, RDF + "first", *item))
                rows.append((me, RDF + "rest", *head))
                head = (me, "bnode", "", "")
            return head
        if kind == "bnode":
            i += 1
            return f"_:{scope}{value[2:]}", "bnode", "", ""
        if kind == "str":
            i += 1
            body = unescape(value[3:-3] if value[:3] in ('"""', "'''") else value[1:-1])
            if is_op("^^"):
                i += 1
                return body, "literal", iri(), ""
            if i < len(tokens) and tokens[i][0] == "at":
                i += 1
                return body, "literal", "", tokens[i - 1][1][1:].lower()
            return body, "literal", XSD + "string", ""
        if kind == "num":
            i += 1
            return value, "literal", XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"), ""
        if kind == "word" and value in ("true", "false"):
            i += 1
            return value, "literal", XSD + "boolean", ""
        return iri(), "iri", "", ""

    def properties(subject: str) -> None:
        nonlocal i
        while True:
            p = iri()
            while True:
                o = term()
                rows.append((subject, p, *o))
                if not is_op(","):
                    break
                i += 1
            if not is_op(";"):
                return
            while is_op(";"):
                i += 1
            if is_op(".") or is_op("]"):
                return

    while i < len(tokens):
        kind, value = tokens[i]
        low = value.lower()
        if low in ("@prefix", "prefix") and kind in ("at", "word"):
            prefixes[tokens[i + 1][1][:-1]] = tokens[i + 2][1][1:-1]
            i += 3
        elif low in ("@base", "base") and kind in ("at", "word"):
            base = tokens[i + 1][1][1:-1]
            i += 2
        else:
            subject, _, _, _ = term()
            if not is_op("."):
                properties(subject)
        if is_op("."):
            i += 1
        yield from rows
        rows.clear()


def _quoted(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def _rendered(prefixes: dict[str, str]) -> tuple[Column, Column, Column]:
    def iri(c: Column) -> Column:
        out = F.concat(F.lit("<"), c, F.lit(">"))
        for name, ns in prefixes.items():
            out = F.when(c.startswith(ns) & F.substring(c, len(ns) + 1, 2**31 - 1).rlike(r"^[A-Za-z_][A-Za-z0-9_-]*$"), F.concat(F.lit(name + ":"), F.substring(c, len(ns) + 1, 2**31 - 1))).otherwise(out)
        return out

    node = lambda c: F.when(c.startswith("_:"), c).otherwise(iri(c))
    kind = F.coalesce("datatype", F.lit(""))
    tail = F.when(F.coalesce("lang", F.lit("")) != "", F.concat(F.lit("@"), F.col("lang"))).when(kind.isin("", XSD + "string"), F.lit("")).otherwise(F.concat(F.lit("^^"), iri(kind)))
    return node(F.col("s")), iri(F.col("p")), F.when(F.col("o_kind") == "literal", F.concat(_quoted(F.col("o")), tail)).otherwise(node(F.col("o")))


def to_ntriples(graph: DataFrame) -> DataFrame:
    """One line per triple, for ``write.text``."""
    s, p, o = _rendered({})
    return graph.select(F.concat_ws(" ", s, p, o, F.lit(".")).alias("value"))


def to_turtle(graph: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """One block per subject; the prefixes stand in `turtle_header`."""
    s, p, o = _rendered(prefixes or PREFIXES)
    lines = graph.select(s.alias("s"), F.concat_ws(" ", p, o).alias("po"))
    return lines.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set("po")), " ;\n    ").alias("po")).select(F.concat("s", F.lit(" "), "po", F.lit(" .")).alias("value"))


def turtle_header(prefixes: dict[str, str] | None = None) -> str:
    return "".join(f"@prefix {k}: <{v}> .\n" for k, v in (prefixes or PREFIXES).items())


def to_owl_xml(graph: DataFrame) -> DataFrame:
    """RDF/XML, one ``rdf:Description`` per triple, for ``write.text`` between the tags of `owl_xml_frame`."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    cut = F.regexp_extract("p", r"^(.*[#/])([^#/]+)$", 1)
    local = F.regexp_extract("p", r"^(.*[#/])([^#/]+)$", 2)
    about = F.when(F.col("s").startswith("_:"), F.concat(F.lit('rdf:nodeID="'), F.substring("s", 3, 10**6))).otherwise(F.concat(F.lit('rdf:about="'), esc(F.col("s"))))
    link = F.when(F.col("o_kind") == "bnode", F.concat(F.lit(' rdf:nodeID="'), F.substring("o", 3, 10**6), F.lit('"/>'))).otherwise(F.concat(F.lit(' rdf:resource="'), esc(F.col("o")), F.lit('"/>')))
    kind = F.when(F.coalesce("datatype", F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit(' rdf:datatype="'), esc(F.col("datatype")), F.lit('"')))
    value = F.when(F.col("o_kind") == "literal", F.concat(kind, F.lit(">"), esc(F.col("o")), F.lit("</n:"), local, F.lit(">"))).otherwise(link)
    return graph.select(F.concat(F.lit("<rdf:Description "), about, F.lit('"><n:'), local, F.lit(' xmlns:n="'), esc(cut), F.lit('"'), value, F.lit("</rdf:Description>")).alias("value"))


def owl_xml_frame() -> tuple[str, str]:
    return f'<rdf:RDF xmlns:rdf="{RDF}">', "</rdf:RDF>"
