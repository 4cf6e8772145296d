"""Model-backed operators behind one protocol: batches go to a provider inside tasks, and a failure has a fixed outcome.

A provider answers a task's payloads with one dictionary each; fewer answers or none are allowed. `LocalProvider`
answers by rule, alike everywhere; `HttpProvider` asks a generation server.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.request
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ternion.functions import text as T
from ternion.functions.parsing import agent_json, chain_spans, replace_spans, tolerant_json

#: Batch sizes by task; others are asked one by one.
BATCHES = {"relations": 4, "describe": 15, "classify_entity": 15, "classify_relation": 15, "annotate": 15}
EMBED_ATTEMPTS, DIMENSIONS, MENTION = 3, 64, re.compile(r"\b[A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+)*\b")


class ModelProvider(Protocol):
    """Answers to payloads of one task, in their order. Raising means that the batch failed. Must be picklable."""

    def answer(self, task: str, payloads: Sequence[dict]) -> list[dict]: ...


class LocalProvider:
    """Answers by rule: mentions are entities, two mentions of a sentence are related by the words between them."""

    def answer(self, task: str, payloads: Sequence[dict]) -> list[dict]:
        return [getattr(self, "_" + task)(p) for p in payloads]

    def _paraphrase(self, p: dict) -> dict:
        return {"paraphrased_text": p["text"]}

    def _coref(self, p: dict) -> dict:
        """Pronouns at a sentence's start stand for the last mention before them."""
        last, chains = None, []
        for m in re.finditer(r"(?:(?<=[.!?] )|^)(?:It|They|He|She)\b|" + MENTION.pattern, p["text"]):
            if m[0] in ("It", "They", "He", "She"):
                chains += [[last, m.span()]] if last else []
            else:
                last = m.span()
        return {"text": replace_spans(p["text"], chain_spans(p["text"], chains))}

    def _relations(self, p: dict) -> dict:
        found, out = list(MENTION.finditer(p["text"])), []
        for a, b in zip(found, found[1:], strict=False):
            between = p["text"][a.end() : b.start()].strip(" ,;:.")
            if between and len(between.split()) <= 4 and not re.search("[.!?]", between):
                out.append(f"<triplet> {a[0]} <subj> {b[0]} <obj> {between}")
        return {"linearised": " ".join(out)}

    def _ner(self, p: dict) -> dict:
        places = ("Station", "Street", "Airport", "Road", "Park", "Bridge")
        return {"entities": [{"surface": m, "label": "FAC" if m.endswith(places) else "ORG"} for m in dict.fromkeys(MENTION.findall(p["text"])) if " " in m]}

    def _extract(self, p: dict) -> dict:
        return {"triplets": []}

    def _describe(self, p: dict) -> dict:
        return {"description": p["name"]}

    def _embed(self, p: dict) -> dict:
        """Hashed words and letter triples as a vector of unit length."""
        v = np.zeros(DIMENSIONS)
        low = " ".join(re.findall(r"\w+", p["text"].lower()))
        for x in [*low.split(), *(low[i : i + 3] for i in range(len(low) - 2))]:
            h = hashlib.sha256(x.encode()).digest()
            v[h[0] % DIMENSIONS] += 1.0 if h[1] % 2 else -1.0
        size = float(np.sqrt(v @ v))
        return {"vector": (v / size if size else v).tolist()}

    def _classify_entity(self, p: dict) -> dict:
        return {"type": "class" if p["name"][:1].islower() and p["name"].endswith("s") else "individual"}

    def _classify_relation(self, p: dict) -> dict:
        return {"type": "datatype_property" if p.get("has_literal") else "object_property", "symmetric": False, "transitive": False, "functional": False}

    def _annotate(self, p: dict) -> dict:
        return {"label": p["name"], "comment": ""}

    def _same(self, p: dict) -> dict:
        return {"same": True}

    def _canonical(self, p: dict) -> dict:
        return {"canonical": min(p["names"], key=len)}

    def _zone(self, p: dict) -> dict:
        return {"answer": str(int(hashlib.sha256(p["name"].encode()).hexdigest(), 16) % 9 + 1)}


class HttpProvider:
    """A generation server's answers: JSON asked for, streamed, what came by the deadline parsed; bad JSON is asked for again with another seed."""

    def __init__(self, url: str, model: str, prompts: dict[str, str], seconds: float = 120.0, temperature: float = 0.3, seed: int = 42, tries: int = 3, options: dict | None = None):
        self.url, self.model, self.prompts, self.seconds, self.seed, self.tries = url, model, prompts, seconds, seed, tries
        self.options = {"temperature": temperature, "repeat_penalty": 1.15, **(options or {})}

    def answer(self, task: str, payloads: Sequence[dict]) -> list[dict]:
        return [self.one(self.prompts[task] + json.dumps(p)) for p in payloads]

    def one(self, prompt: str) -> dict:
        for n in range(self.tries):
            body = {"model": self.model, "prompt": prompt, "stream": True, "format": "json", "options": {**self.options, "seed": self.seed + n}}
            try:
                return tolerant_json(self.stream(body))
            except ValueError:
                if n == self.tries - 1:
                    raise
        raise ValueError("no tries")

    def stream(self, body: dict) -> str:
        """The text of a streamed answer; a timeout ends it early."""
        text, deadline = "", time.monotonic() + self.seconds
        request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.seconds) as lines:
                for line in lines:
                    part = json.loads(line) if line.strip() else {}
                    text += part.get("response", "")
                    if part.get("done") or time.monotonic() > deadline:
                        break
        except TimeoutError:
            pass
        return text


def ask(rows: DataFrame, provider: ModelProvider, task: str, payload: Column, answer: str, default: Column | None = None, tries: int = 1) -> DataFrame:
    """``rows`` with column ``answer``: each row's answer as JSON text; ``default`` where its batch failed, or the answer is missing.

    Rows go in batches of the task's size within a partition; a failed batch is asked again up to ``tries`` times.
    """
    size = BATCHES.get(task, 1)
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.to_json(payload).alias("_payload"))
    schema = packed.select("_row").schema.add("_answer", "string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[str | None] = []
            payloads = [json.loads(x) for x in pdf["_payload"]]
            for at in range(0, len(payloads), size):
                part, got = payloads[at : at + size], []
                for _ in range(tries):
                    try:
                        got = provider.answer(task, part)
                        break
                    except Exception:  # whatever a provider raises, the batch counts as failed
                        continue
                out += [json.dumps(got[i]) if i < len(got) and isinstance(got[i], dict) else None for i in range(len(part))]
            yield pd.DataFrame({"_row": pdf["_row"], "_answer": out})

    done = packed.mapInPandas(run, schema).select("_row.*", F.col("_answer").alias(answer))
    return done if default is None else done.withColumn(answer, F.coalesce(answer, F.to_json(default)))


def _get(c: str, field: str) -> Column:
    return F.get_json_object(c, f"$.{field}")


def paraphrased(chunks: DataFrame, provider: ModelProvider) -> DataFrame:
    """L1 over ``text``: the paraphrase, the text itself where none came."""
    out = ask(chunks, provider, "paraphrase", F.struct("text"), "_a")
    return out.withColumn("text", F.coalesce(_get("_a", "paraphrased_text"), "text")).drop("_a")


def resolved(docs: DataFrame, provider: ModelProvider) -> DataFrame:
    """L2 over ``text``: mentions replaced by what they stand for, the text itself where that fails."""
    out = ask(docs, provider, "coref", F.struct("text"), "_a")
    return out.withColumn("text", F.coalesce(_get("_a", "text"), "text")).drop("_a")


def relation_triplets(sentences: DataFrame, provider: ModelProvider) -> DataFrame:
    """L3 over ``(doc_id, seq, text)``: triplets read from linearised answers; failed batches give none."""
    out = ask(sentences, provider, "relations", F.struct("text"), "_a")
    found = out.select("doc_id", "seq", "text", F.posexplode(T.linearised_triplets(F.coalesce(_get("_a", "linearised"), F.lit("")))).alias("k", "t"))
    return found.select("doc_id", (F.col("seq") * 1000 + F.col("k")).cast("long").alias("seq"), "t.*", F.col("text").alias("provenance_sentence"))


def entity_triplets(docs: DataFrame, provider: ModelProvider) -> DataFrame:
    """L4 with F3 over ``(doc_id, text)``: a type triplet for each known entity; a failure gives none."""
    from ternion.operators.triplets import keep_entities

    out = ask(docs, provider, "ner", F.struct("text"), "_a")
    listed = F.from_json(_get("_a", "entities"), "array<struct<surface:string,label:string>>")
    found = out.select("doc_id", T.provenance(F.col("text")).alias("provenance_sentence"), F.posexplode(listed).alias("seq", "e")).select("doc_id", "provenance_sentence", F.col("seq").cast("long").alias("seq"), T.strip(F.col("e.surface")).alias("surface"), "e.label")
    return keep_entities(found).select("doc_id", "seq", F.col("surface").alias("subject"), F.lit("type").alias("predicate"), F.col("type").alias("object"), "provenance_sentence")


def extracted_triplets(chunks: DataFrame, provider: ModelProvider) -> DataFrame:
    """L5 with F2 over ``(doc_id, seq, text)``: the triplets a model lists; failed chunks give none."""
    from ternion.operators.triplets import keep_triplets

    out = ask(chunks, provider, "extract", F.struct("text"), "_a")
    listed = F.from_json(_get("_a", "triplets"), "array<struct<subject:string,predicate:string,object:string>>")
    found = out.select("doc_id", "seq", T.provenance(F.col("text")).alias("provenance_sentence"), F.posexplode(listed).alias("k", "t"))
    parts = [T.strip(F.coalesce(f"t.{c}", F.lit(""))).alias(c) for c in ("subject", "predicate", "object")]
    return keep_triplets(found.select("doc_id", (F.col("seq") * 1000 + F.col("k")).cast("long").alias("seq"), *parts, "provenance_sentence"), predicate_too=True)


def described(names: DataFrame, provider: ModelProvider) -> DataFrame:
    """L6, L13 over ``name``: with ``description``, the name itself where none came."""
    out = ask(names, provider, "describe", F.struct("name"), "_a")
    return out.withColumn("description", F.coalesce(F.nullif(_get("_a", "description"), F.lit("")), "name")).drop("_a")


def embedded(described_: DataFrame, provider: ModelProvider) -> DataFrame:
    """L7 over ``description``: with ``vec``, empty where three attempts failed."""
    out = ask(described_, provider, "embed", F.struct(F.col("description").alias("text")), "_a", tries=EMBED_ATTEMPTS)
    return out.withColumn("vec", F.coalesce(F.from_json(_get("_a", "vector"), "array<double>"), F.array().cast("array<double>"))).drop("_a")


def filled(names: DataFrame, state: DataFrame, provider: ModelProvider) -> DataFrame:
    """``(base_category, name, description, vec)``: what ``state`` holds of the names, and the rest described and embedded now."""
    key = ["base_category", "name"]
    wanted = names.select(*key).distinct()
    fresh = embedded(described(wanted.join(state.select(*key), key, "left_anti"), provider), provider)
    return state.join(wanted, key, "left_semi").select(*key, "description", "vec").unionByName(fresh.select(*key, "description", "vec"))


def classified(names: DataFrame, provider: ModelProvider) -> DataFrame:
    """L8, L9 over ``(base_category, name, usage, near, has_literal)``: with kind and characteristics; missing answers are null and take their defaults in `classify`."""
    entity = ask(names.where("base_category = 'entities'"), provider, "classify_entity", F.struct("name", "usage", "near"), "_a")
    relation = ask(names.where("base_category = 'relations'"), provider, "classify_relation", F.struct("name", "usage", "near", "has_literal"), "_a")
    flag = lambda c: _get("_a", c).try_cast("boolean").alias(c)
    return entity.unionByName(relation).select("base_category", "name", _get("_a", "type").alias("kind"), flag("symmetric"), flag("transitive"), flag("functional"))


def annotated(catalog: DataFrame, provider: ModelProvider) -> DataFrame:
    """L10 over ``(name, kind, ...)``: with label and comment, the name and nothing where none came."""
    out = ask(catalog, provider, "annotate", F.struct("name", "kind"), "_a")
    return out.withColumn("label", F.coalesce(F.nullif(_get("_a", "label"), F.lit("")), "name")).withColumn("comment", F.coalesce(_get("_a", "comment"), F.lit(""))).drop("_a")


def judged(members: DataFrame, provider: ModelProvider, kind: str) -> DataFrame:
    """L11 over ``(name, cluster)``: ``(cluster, same)`` of clusters of several names; a failure keeps the cluster."""
    groups = members.groupBy("cluster").agg(F.array_sort(F.collect_list("name")).alias("names")).where(F.size("names") > 1)
    out = ask(groups, provider, "same", F.struct(F.lit(kind).alias("type"), "names"), "_a")
    return out.select("cluster", F.coalesce(_get("_a", "same").try_cast("boolean"), F.lit(True)).alias("same"))


def named(members: DataFrame, provider: ModelProvider) -> DataFrame:
    """L12, G7 over ``(name, cluster, known, is_new)``: ``(name, cluster, canonical)``: the smallest known name of a cluster, else the one the provider gives, else the shortest."""
    grouped = members.groupBy("cluster").agg(F.min(F.when(F.col("known"), F.col("name"))).alias("kn"), F.array_sort(F.collect_list(F.when(F.col("is_new"), F.col("name")))).alias("names"))
    asked = ask(grouped.where("kn IS NULL AND size(names) > 0"), provider, "canonical", F.struct("names"), "_a")
    shortest = F.array_min(F.transform("names", lambda x: F.struct(F.char_length(x), x.alias("x")))).getField("x")
    chosen = asked.select("cluster", F.coalesce(F.when(F.col("_a").isNotNull(), F.coalesce(F.nullif(_get("_a", "canonical"), F.lit("")), F.get("names", F.lit(0)))), shortest).alias("canonical"))
    best = grouped.where("kn IS NOT NULL").select("cluster", F.col("kn").alias("canonical")).unionByName(chosen)
    return members.join(best, "cluster", "left").select("name", "cluster", F.coalesce("canonical", "name").alias("canonical"))


def zone_answers(gaps: DataFrame, provider: ModelProvider) -> DataFrame:
    """L15 over ``(station, name)``: with ``answer``; null where the provider failed."""
    return ask(gaps, provider, "zone", F.struct("name"), "_a").withColumn("answer", _get("_a", "answer")).drop("_a")


def agent(question: str, generate, tool, system: str, turns: int = 4) -> dict:
    """Question and answer over a query tool: ``generate(prompt)`` gives text, ``tool(name, parameters)`` rows; ten rows at most go back. No answer after ``turns``: None."""
    history, log = f"{system}\n\nQuestion: {question}\n", []
    for turn in range(1, turns + 1):
        raw = generate(history)
        got = agent_json(raw)
        if got is None or not {"answer", "tool"} & set(got):
            log.append({"turn": turn, "raw": raw, "error": "unparseable" if got is None else "unknown format"})
            break
        if "answer" in got:
            return {"answer": got["answer"], "turns": [*log, {"turn": turn, "answer": got["answer"]}]}
        parameters = {k: v for k, v in got.items() if k != "tool"}
        rows = tool(got["tool"], parameters)
        log.append({"turn": turn, "tool": got["tool"], "params": parameters, "result": rows})
        history += f"\nAssistant: {raw}\nTool result: {json.dumps(rows[:10] if isinstance(rows, list) else rows)}\n"
    return {"answer": None, "turns": log}
