"""Text, literal and IRI functions: Column in, Column out. Null in, null out unless said otherwise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ternion.schema import XSD

#: Month names and the shapes of date mentions.
MONTHS = "(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
DATES = (
    rf"(?i)\b\d{{1,2}}\s+{MONTHS}\s+\d{{4}}\b",
    rf"(?i)\b{MONTHS}\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"(?i)\b{MONTHS}\s+\d{{4}}\b",
    r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
    r"(?i)\b(?:early|mid|late)[-\s]\d{4}s?\b",
    r"\b\d{4}s\b",
)
#: Words that never block.
STOP_WORDS = ("the", "a", "an", "of", "for", "to", "in", "on", "and", "or", "by", "with", "from", "at", "is", "are")

_EDGES = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, _EDGES, "")


def collapse(c: Column) -> Column:
    """Every run of white space is one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def sentences(c: Column, capital: bool = False) -> Column:
    """Parts after ``.``, ``!`` or ``?`` and white space (before a capital A-Z only, if so asked)."""
    ahead = "(?=[A-Z])" if capital else ""
    return F.filter(F.transform(F.split(c, rf"(?<=[.!?])(?U:\s+){ahead}"), strip), lambda s: s != "")


def tokens(c: Column) -> Column:
    """T4: runs of letters, digits and underscores of any script."""
    return F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def words(c: Column) -> Column:
    """Parts between white space."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def greedy_chunks(parts: Column, limit: int) -> Column:
    """Consecutive parts joined by blanks; a part that would exceed ``limit`` words starts a chunk, and a longer one is a chunk alone."""
    # Words are counted once a part; the fold sees counts alone and keeps where chunks begin, so a text is copied once.
    start = F.struct(F.array().cast("array<int>").alias("begins"), F.lit(0).alias("i"), F.lit(0).alias("n"))

    def step(acc: Column, n: Column) -> Column:
        full = (acc["i"] == 0) | ((acc["n"] + n > limit) & (acc["n"] > 0))
        return F.struct(
            F.when(full, F.concat(acc["begins"], F.array(acc["i"]))).otherwise(acc["begins"]).alias("begins"),
            (acc["i"] + 1).alias("i"),
            F.when(full, n).otherwise(acc["n"] + n).alias("n"),
        )

    def cut(begins: Column) -> Column:
        end = lambda k: F.coalesce(F.get(begins, k + 1), F.size(parts))
        return F.transform(begins, lambda b, k: F.array_join(F.slice(parts, b + 1, end(k) - b), " "))

    counts = F.transform(parts, lambda p: F.size(words(p)))
    found = F.aggregate(counts, start, step, lambda a: a["begins"])
    return F.get(F.transform(F.array(found), cut), 0)  # the one-element array binds what was found: it is computed once


def preprocess(c: Column, limit: int, rewrite: Callable[[Column], Column] | None = None) -> Column:
    """A short text whole, a long one by chunks of sentences, each through ``rewrite`` (null: kept); all empty: unchanged.

    Without ``rewrite`` the chunks would be joined as they were cut, so the sentences are joined at once.
    """
    short = F.size(words(c)) <= limit
    if rewrite is None:
        out = F.when(short, c).otherwise(F.array_join(sentences(c, True), " "))
    else:
        parts = F.array_join(F.transform(greedy_chunks(sentences(c, True), limit), lambda x: F.coalesce(rewrite(x), x)), " ")
        out = F.when(short, F.coalesce(rewrite(c), c)).otherwise(parts)
    # The one-element array binds the result: it is made once and looked at twice.
    return F.get(F.transform(F.array(out), lambda x: F.when(x.rlike(r"(?U)\S"), x).otherwise(c)), 0)


def is_literal(c: Column) -> Column:
    """Whole numbers, decimals, or a text with a date mention in it."""
    test = c.rlike(r"^(?U:\s*)-?\d+(?:\.\d+)?(?U:\s*)$")
    for d in DATES:
        test = test | c.rlike(d)
    return c.rlike(r"\d") & test  # each of them has a digit


def literal_datatype(c: Column) -> Column:
    """The short name of a literal's datatype."""
    s = strip(c)
    return F.when(s.rlike(r"^-?\d+$"), "xsd:integer").when(s.rlike(r"^-?\d+\.\d+$"), "xsd:decimal").otherwise("xsd:string")


def literal_iri(c: Column) -> Column:
    """The datatype's IRI."""
    return F.concat(F.lit(XSD), F.substring(literal_datatype(c), 5, 10))


def literal_lexical(c: Column) -> Column:
    """The lexical form: numbers trimmed, other literals as they are."""
    return F.when(literal_datatype(c) != "xsd:string", strip(c)).otherwise(c)


def mentions(c: Column) -> Column:
    """Distinct runs of capitalised words, ascending."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\b[A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)*\b"), F.lit(0))))


def camel_label(c: Column) -> Column:
    """A blank before each A-Z, then lower case."""
    return F.lower(F.trim(F.regexp_replace(c, "([A-Z])", " $1")))


def slug(c: Column) -> Column:
    """Runs of other characters than A-Z, a-z, 0-9 as one underscore, none at the ends; ``item`` if nothing stays."""
    return F.regexp_replace(F.btrim(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), F.lit("_")), "^$", "item")


def label_norm(c: Column) -> Column:
    """Trimmed, lower case, single blanks."""
    return F.lower(collapse(c))


def surface_norm(c: Column) -> Column:
    """Lower case without leading article, punctuation and one plural s (of more than three letters, not ss)."""
    s = F.regexp_replace(F.lower(strip(c)), r"^(the|a|an)\s+", "")
    s = collapse(F.regexp_replace(s, r"[^\p{L}\p{N}_\s]", " "))
    return F.when(s.rlike("[^s]s$") & (F.char_length(s) > 3), F.regexp_replace(s, "s$", "")).otherwise(s)


def equality_norm(c: Column) -> Column:
    """Lower case, only a-z and 0-9, single blanks."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def block_tokens(c: Column) -> Column:
    """Distinct runs of a-z and 0-9, longer than two, no stop words."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: (F.length(t) > 2) & ~t.isin(*STOP_WORDS)))


def local_name(c: Column) -> Column:
    """Behind the last ``#`` and ``/``, with ``_`` and ``-`` as blanks; the IRI itself if that is empty."""
    tail = F.trim(F.regexp_replace(F.substring_index(F.substring_index(c, "#", -1), "/", -1), "[_-]+", " "))
    return F.when(tail == "", c).otherwise(tail)


def iri_label(c: Column) -> Column:
    """Behind the last ``#``, then ``/``, with ``_`` as blank."""
    return F.replace(F.substring_index(F.substring_index(c, "#", -1), "/", -1), F.lit("_"), F.lit(" "))


def is_iri(c: Column) -> Column:
    """T20."""
    return c.startswith("http://") | c.startswith("https://")


def strip_special(c: Column) -> Column:
    """Without the generator's sentence marks."""
    return F.trim(F.replace(F.replace(c, F.lit("<s>"), F.lit("")), F.lit("</s>"), F.lit("")))


def linearised_triplets(c: Column) -> Column:
    """Array of (subject, predicate, object) from ``<triplet> s <subj> o <obj> p`` text; incomplete ones go.

    Marks stand between white space. A further ``<subj>`` or ``<obj>`` carries its part of the same triplet on.
    """
    end = "(?= <subj> | <obj> |$)"

    def one(body: Column) -> Column:
        grab = lambda mark: F.array_join(F.filter(F.transform(F.regexp_extract_all(body, F.lit(f"(?s) {mark}(?= )(.*?){end}"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != ""), " ")
        return F.struct(F.trim(F.regexp_extract(body, f"(?s)^(.*?){end}", 1)).alias("subject"), grab("<obj>").alias("predicate"), grab("<subj>").alias("object"))

    bodies = F.slice(F.split(F.concat(F.lit(" "), collapse(strip_special(c)), F.lit(" ")), " <triplet>(?= )"), 2, 10**6)
    return F.filter(F.transform(bodies, one), lambda t: (t["subject"] != "") & (t["predicate"] != "") & (t["object"] != ""))


def first_integer(c: Column) -> Column:
    """The first run of digits as a number, null without."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("bigint")


def context(label: Column, comment: Column, parents: Column, domain: Column, range_: Column) -> Column:
    """What is known of a term in one line; nulls are left out."""
    return F.concat_ws("; ", label, comment, F.transform(parents, lambda p: F.concat(F.lit("subclass of "), p)), F.concat(F.lit("domain "), domain), F.concat(F.lit("range "), range_))


def description_source(ctx: Column, described: Column, least: int = 8) -> Column:
    """The context if it has ``least`` words, else a model's description."""
    return F.when(F.size(words(ctx)) >= least, ctx).otherwise(described)


def provenance(c: Column) -> Column:
    """The first 200 characters."""
    return F.substring(c, 1, 200)


def usage(s: Column, p: Column, o: Column) -> Column:
    """T33."""
    return F.concat(F.lit('"'), s, F.lit('" → '), p, F.lit(' → "'), o, F.lit('"'))
