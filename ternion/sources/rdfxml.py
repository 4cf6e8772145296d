"""RDF/XML as rows of a graph, and the choice between it and Turtle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urljoin
from xml.etree import ElementTree

from ternion.schema import RDF, RDF_TYPE, XSD
from ternion.sources.turtle import parse_turtle

_XML = "{http://www.w3.org/XML/1998/namespace}"
_R = "{" + RDF + "}"
_PLACES = {_R + x for x in ("about", "ID", "nodeID", "resource", "datatype", "parseType")}
Row = tuple[str, str, str, str, str, str]


def scope_of(path: str) -> str:
    """The scope of a file's blank labels: the same in every process, another for every path."""
    return "f" + hashlib.sha256(path.encode()).hexdigest()[:16] + "_"


def _iri(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag


class _Reader:
    def __init__(self, scope: str):
        self.scope, self.blanks, self.rows = scope, 0, []

    def fresh(self) -> tuple[str, str]:
        self.blanks += 1
        return f"_:{self.scope}g{self.blanks}", "bnode"

    def place(self, e: ElementTree.Element, base: str) -> tuple[str, str]:
        """What a node element is: an IRI or a blank label."""
        if (about := e.get(_R + "about")) is not None:
            return urljoin(base, about) if about or base else about, "iri"
        if (own := e.get(_R + "ID")) is not None:
            return urljoin(base, "#" + own), "iri"
        if (label := e.get(_R + "nodeID")) is not None:
            return f"_:{self.scope}{label}", "bnode"
        return self.fresh()

    def add(self, s: str, p: str, o: str, kind: str, datatype: str = "", lang: str = "") -> None:
        self.rows.append((s, p, o, kind, datatype, lang))

    def node(self, e: ElementTree.Element, base: str, lang: str) -> tuple[str, str]:
        base, lang = e.get(_XML + "base", base), e.get(_XML + "lang", lang)
        me, kind = self.place(e, base)
        if e.tag != _R + "Description":
            self.add(me, RDF_TYPE, _iri(e.tag), "iri")
        self.attributes(me, e, lang)
        for child in e:
            self.property(me, child, base, lang)
        return me, kind

    def attributes(self, me: str, e: ElementTree.Element, lang: str) -> None:
        for name, value in e.attrib.items():
            if name == RDF_TYPE or name == _R + "type":
                self.add(me, RDF_TYPE, value, "iri")
            elif name.startswith("{") and name not in _PLACES and not name.startswith(_XML):
                self.add(me, _iri(name), value, "literal", "" if lang else XSD + "string", lang)

    def property(self, me: str, e: ElementTree.Element, base: str, lang: str) -> None:
        p, lang, form = _iri(e.tag), e.get(_XML + "lang", lang), e.get(_R + "parseType")
        if form == "Collection":
            items = [self.node(x, base, lang) for x in e]
            head = (RDF + "nil", "iri")
            for item in reversed(items):
                cell = self.fresh()
                self.add(cell[0], RDF + "first", *item)
                self.add(cell[0], RDF + "rest", *head)
                head = cell
            self.add(me, p, *head)
        elif form == "Resource":
            blank = self.fresh()
            self.add(me, p, *blank)
            for child in e:
                self.property(blank[0], child, base, lang)
        elif form is not None:
            self.add(me, p, (e.text or "") + "".join(ElementTree.tostring(x, "unicode") for x in e), "literal", RDF + "XMLLiteral")
        elif (to := e.get(_R + "resource")) is not None:
            self.add(me, p, urljoin(base, to) if base else to, "iri")
        elif (label := e.get(_R + "nodeID")) is not None:
            self.add(me, p, f"_:{self.scope}{label}", "bnode")
        elif len(e):
            for child in e:
                self.add(me, p, *self.node(child, base, lang))
        elif any(name.startswith("{") and name not in _PLACES and not name.startswith(_XML) for name in e.attrib):
            blank = self.fresh()
            self.add(me, p, *blank)
            self.attributes(blank[0], e, lang)
        else:
            kind = e.get(_R + "datatype", "")
            self.add(me, p, e.text or "", "literal", kind or ("" if lang else XSD + "string"), "" if kind else lang.lower())


def parse_rdfxml(text: str, scope: str = "") -> Iterator[Row]:
    """Rows (s, p, o, o_kind, datatype, lang) of an RDF/XML document; ValueError if it is none."""
    try:
        root = ElementTree.fromstring(text.encode())
    except ElementTree.ParseError as e:
        raise ValueError(f"RDF/XML syntax error: {e}") from e
    reader, base, lang = _Reader(scope), root.get(_XML + "base", ""), root.get(_XML + "lang", "")
    for e in root if root.tag == _R + "RDF" else [root]:
        reader.node(e, base, lang)
    return iter(reader.rows)


def parse_graph(text: str, path: str = "") -> list[Row]:
    """A file's rows: Turtle for ``.ttl``, RDF/XML for others, and the other of the two where that fails."""
    scope = scope_of(path)
    order = (parse_turtle, parse_rdfxml) if path.lower().endswith(".ttl") else (parse_rdfxml, parse_turtle)
    try:
        return list(order[0](text, scope))
    except (ValueError, KeyError, IndexError) as first:
        try:
            return list(order[1](text, scope))
        except (ValueError, KeyError, IndexError):
            raise first from None
