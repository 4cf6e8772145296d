"""SPARQL 1.1 SELECT and ASK over a triples DataFrame: text -> tree -> Catalyst plan."""

from ternion.plans.sparql.lower import Engine
from ternion.plans.sparql.parser import parse, split_corpus

__all__ = ["Engine", "parse", "split_corpus"]
