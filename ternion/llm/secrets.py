"""Secret scans: candidates by shape, false positives removed by a random forest.

Candidates are runs of at least twelve bytes of the characters that keys are written with, holding a digit or
standing behind an assignment; values of any length and characters behind an assignment sign or a word of
``NEAR_KEYS``, past blanks and quotes; and PEM private-key blocks. Candidates may overlap. The forest sees length, shares of character
classes, entropy, character transitions (how often the class changes, and the log-likelihood of the letter
pairs under prose), coverage by a small dictionary, the path the text comes from and the neighbouring words.
It is trained from labelled findings: rows of (value, before, after, path, label). Where a caller has none,
`labelled_findings` makes them by rule from publicly documented key formats and from the things scanners
usually mistake for keys (addresses, digests of commits, card numbers, versions, links, identifiers).

Nulls and edge cases: null and empty texts have no findings; a null path is the empty path; equal findings in
one text are separate rows; rows with equal or null doc_ids are scanned each for itself; other columns are
ignored by the scan and kept by the redaction; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ternion.llm import textbytes as tb
from ternion.llm.tables import handing_back, small_batches

LEAST, AROUND, TREES, DEPTH, THRESHOLD, SEED, FINDINGS = 12, 48, 40, 9, 0.5, 11, 6000

_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_-.~@%$*"]] = False
_DIGIT = np.zeros(256, np.int64)
_DIGIT[0x30:0x3A] = 1
_EQUALS = np.zeros(256, bool)
_EQUALS[list(b"=:\"'")] = True

# Words beside keys, words beside things that look like keys, parts of words inside ordinary identifiers.
NEAR_KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api", "key", "access", "auth", "bearer", "credential", "private", "aws", "client_secret")
NEAR_OTHERS = ("commit", "sha", "md5", "sha1", "sha256", "checksum", "digest", "uuid", "id", "version", "phone", "tel", "ip", "host", "mail", "email", "card", "iban", "isbn", "doi", "date", "build", "etag", "revision")
DICTIONARY = ("example", "mail", "http", "https", "www", "com", "org", "net", "html", "index", "test", "version", "user", "name", "image", "file", "path", "data", "docs", "page", "static", "public", "lib", "src", "main", "release", "config", "local", "license", "copyright", "the", "and", "with", "from", "change", "value", "default", "your", "key", "here")
_ASSIGNED = re.compile(
    rb"(?:(?i:" + b"|".join(sorted((w.encode() for w in NEAR_KEYS), key=len, reverse=True)) + rb")[\"']?(?:[ \t]*[=:]+>?[ \t]*|[ \t]+)|[=:]+>?[ \t]*)"
    rb"(?:\"([^\"\n]+)\"|'([^'\n]+)'|[\"']?([^\s\"'=:][^\s\"']*))"
)
_TEST_PATHS = ("test", "example", "sample", "fixture", "doc", "mock")
_PAIRS = "theandingionentatiherereredesarontestonalorofitisinasleveconnededticomeouvellanterlitrasedelaquechsciundderdieungkeischbeverlosrasest"


def _prose() -> np.ndarray:
    table = np.ones((27, 27))
    code = [ord(c) - 96 if c.isalpha() else 0 for c in _PAIRS]
    for a, b in zip(code, code[1:], strict=False):
        table[a, b] += 4
    return np.log(table / table.sum(1, keepdims=True))


_PROSE = _prose()
NAMES = ("length", "upper", "lower", "digit", "other", "hex", "entropy", "changes", "pairs", "dictionary", "distinct", "dots", "at", "slashes", "dashes", "near_key", "near_other", "assigned", "quoted", "test_path", "pem", "digits_only", "no_lower", "prefix_run")


def features(value: str, before: str, after: str, path: str) -> list[float]:
    """The forest's inputs for one candidate."""
    n = len(value)
    kinds = [1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else 4 for c in value]
    share = [kinds.count(k) / n for k in (1, 2, 3, 4)]
    count = {c: value.count(c) for c in set(value)}
    entropy = -sum(v / n * math.log2(v / n) for v in count.values())
    low = value.lower()
    code = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in low]
    pairs = [_PROSE[a, b] for a, b in zip(code, code[1:], strict=False) if a and b]
    covered = [False] * n
    for word in DICTIONARY:
        at = low.find(word)
        while at >= 0:
            covered[at : at + len(word)] = [True] * len(word)
            at = low.find(word, at + 1)
    words = "".join(c if c.isalnum() or c == "_" else " " for c in before.lower()).split()[-3:]
    stripped = before.rstrip(" ")
    run = next((i for i, k in enumerate(kinds) if k != kinds[0]), n)
    return [
        math.log(n), *share, sum(c in "0123456789abcdef" for c in low) / n, entropy, sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        sum(pairs) / len(pairs) if pairs else -9.0, sum(covered) / n, len(count) / n, low.count("."), low.count("@"), low.count("/"), low.count("-"),
        float(any(w in NEAR_KEYS or any(w.endswith(k) for k in NEAR_KEYS if len(k) > 4) for w in words)), float(any(w in NEAR_OTHERS for w in words)),
        float(stripped.rstrip("\"'").rstrip(" ").endswith(("=", ":"))), float(before.endswith(('"', "'")) and after.startswith(('"', "'"))),
        float(any(t in path.lower() for t in _TEST_PATHS)), float(value.startswith("-----BEGIN")), float(share[2] == 1.0), float(share[1] == 0.0 and share[0] > 0), run / n,
    ]


def labelled_findings(n: int = FINDINGS, seed: int = SEED) -> list[tuple[str, str, str, str, int]]:
    """``n`` findings (value, before, after, path, label) by rule: half of them keys."""
    rng = random.Random(seed)
    up, low, digits, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    syllables = [a + b for a in "bcdfghlmnprstvw" for b in ("a", "e", "i", "o", "u", "er", "en", "ion")]
    take = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(2, 6)))
    assign = lambda k: f"{prose()} {k}{rng.choice(['=', ' = ', ': ', '=' + chr(34), ' = ' + chr(34), ': ' + chr(34)])}"
    keys = [
        lambda: ("AKIA" + take(up + digits, 16), prose() + " "), lambda: ("ASIA" + take(up + digits, 16), assign("aws_access_key_id")),
        lambda: ("ghp_" + take(up + low + digits, 36), rng.choice([prose() + " ", assign("token")])), lambda: ("xoxb-" + take(digits, 11) + "-" + take(up + low + digits, 24), prose() + " "),
        lambda: ("sk_live_" + take(up + low + digits, 24), rng.choice([prose() + " ", assign("key")])), lambda: (take(hexa, rng.choice([16, 18, 20, 24, 32, 40, 64])), assign(rng.choice(["password", "token", "secret", "api_key", "auth_token", "passwd", "pwd"]))),
        lambda: (take(up + low + digits, rng.randint(14, 44)), assign(rng.choice(["password", "token", "secret", "client_secret", "access_key", "apikey"]))), lambda: (base64.b64encode(rng.randbytes(rng.randint(15, 45))).decode().rstrip("="), assign("secret")),
        lambda: ("eyJ" + take(up + low + digits, 30) + "." + take(up + low + digits + "_-", 40) + "." + take(up + low + digits + "_-", 30), rng.choice([prose() + " bearer ", prose() + " "])), lambda: ("AIza" + take(up + low + digits + "_-", 35), prose() + " "),
        lambda: (take(up + low + digits + "!#&^%$", rng.randint(7, 16)), assign(rng.choice(["password", "passwd", "pwd", "secret"]))), lambda: (word() + word() + take(digits + "!#&", rng.randint(0, 4)), assign(rng.choice(["password", "passwd", "pwd", "secret"]))),
        lambda: ("-----BEGIN RSA PRIVATE KEY-----\n" + base64.b64encode(rng.randbytes(90)).decode() + "\n-----END RSA PRIVATE KEY-----", prose() + "\n"),
    ]
    others = [
        lambda: (f"{word()}.{rng.randint(1, 99)}@{word()}{rng.randint(0, 9)}.example.com", prose() + " "), lambda: (".".join(str(rng.randint(0, 255)) for _ in range(4)), prose() + " "),
        lambda: (take("456", 1) + take(digits, rng.choice([14, 15, 15, 15])), prose() + " "), lambda: (str(uuid.UUID(int=rng.getrandbits(128))), rng.choice([prose() + " ", assign("id")])),
        lambda: (take(hexa, 40), prose() + rng.choice([" commit ", " revision ", " sha1 "])), lambda: (take(hexa, rng.choice([32, 64])), prose() + rng.choice([" md5 ", " sha256 ", " checksum ", " digest: "])),
        lambda: (f"//www.{word()}.com/{word()}/{rng.randint(1, 9999)}/{word()}.html", prose() + " https:"), lambda: (f"{word()}-{word()}-{rng.randint(1, 20)}.{rng.randint(0, 30)}.{rng.randint(0, 9)}", prose() + rng.choice([" version ", " "])),
        lambda: (f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}", prose() + " "), lambda: (f"/usr/{word()}/{word()}{rng.randint(1, 9)}/{word()}.{rng.choice(['py', 'so', 'txt'])}", prose() + " "),
        lambda: ("+" + take(digits, 12), prose() + rng.choice([" phone ", " "])), lambda: (f"{word()}{word()}{rng.randint(0, 99)}", rng.choice([prose() + " ", assign("name"), assign("id")])),
        lambda: (f"{word()}_{word()}_{word()}{rng.randint(0, 9)}", prose() + " "), lambda: (f"{rng.randint(100, 999)}-{rng.randint(100, 999)}-{take(digits, 4)}", prose() + " "),
        lambda: (word() + word() + word() + word(), assign(rng.choice(["title", "name", "class", "href"]))),
        lambda: (word(), assign(word())), lambda: (take(digits, rng.randint(1, 4)), assign(word())), lambda: (word(), prose() + f" {rng.choice(NEAR_KEYS)} "),
    ]
    out = []
    for i in range(n):
        label = i % 2
        value, before = rng.choice(keys if label else others)()
        quote = before[-1] if before[-1] in "\"'" else ""
        out.append((value, before[-AROUND:], quote + rng.choice([" ", ". ", "\n", ", "]) + word(), rng.choice(["", "src1", "docs/readme", "web"]), label))
    return out


class Forest:
    """Binary trees on thresholds: bootstrap rows, a random subset of features at each node, Gini gain."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, seed: int = SEED):
        self.size, self.depth, self.seed, self.trees = trees, depth, seed, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.size):
            at = rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            self._grow(x[at], y[at], 0, nodes, rng)
            self.trees.append(np.array(nodes))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, level: int, nodes: list[list[float]], rng: np.random.Generator) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y.mean())])
        if level == self.depth or len(y) < 6 or y.min() == y.max():
            return me
        best = (0.0, -1, 0.0)
        whole = y.mean() * (1 - y.mean()) * len(y)
        for f in rng.choice(x.shape[1], max(2, int(math.sqrt(x.shape[1]))), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, s = x[order, f], np.cumsum(y[order])
            cutable = np.flatnonzero(v[1:] > v[:-1])
            if len(cutable):
                left = cutable + 1.0
                a, b = s[cutable], s[-1] - s[cutable]
                gain = whole - (a - a * a / left) - (b - b * b / (len(y) - left))
                j = int(gain.argmax())
                if gain[j] > best[0] + 1e-9:
                    best = (float(gain[j]), int(f), float((v[cutable[j]] + v[cutable[j] + 1]) / 2))
        if best[1] >= 0:
            go = x[:, best[1]] <= best[2]
            nodes[me][:2] = [best[1], best[2]]
            nodes[me][2] = self._grow(x[go], y[go], level + 1, nodes, rng)
            nodes[me][3] = self._grow(x[~go], y[~go], level + 1, nodes, rng)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of key among the leaves that each row reaches."""
        total = np.zeros(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = tree[at, 0].astype(int)
                inner = f >= 0
                go = x[np.arange(len(x)), np.maximum(f, 0)] <= tree[at, 1]
                at = np.where(inner, np.where(go, tree[at, 2], tree[at, 3]).astype(int), at)
            total += tree[at, 4]
        return total / max(1, len(self.trees))


def train(findings: Sequence[tuple[str, str, str, str, int]] | None = None, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """A forest from labelled findings (value, before, after, path, label)."""
    rows = findings if findings is not None else labelled_findings()
    return Forest(trees, depth).fit(np.array([features(*r[:4]) for r in rows]), np.array([float(r[4]) for r in rows]))


def candidates(column) -> list[tuple[int, int, int]]:
    """(row, first byte, end byte) of all candidates of a text column, bytes counted in their own text."""
    data, off = tb.flat(column)
    starts, ends, row = tb.words(data, off, _APART)
    fit = ends - starts >= LEAST
    starts, ends, row = starts[fit], ends[fit], row[fit]
    sums = np.r_[0, np.cumsum(_DIGIT[data])]
    behind = np.zeros(len(starts), bool)
    inner = starts > off[row]
    behind[inner] = _EQUALS[data[starts[inner] - 1]]
    keep = (sums[ends] > sums[starts]) | behind
    starts, ends, row = starts[keep], ends[keep], row[keep]
    raw = data.tobytes()
    found = []
    at = raw.find(b"-----BEGIN ")
    while at >= 0:
        r = int(np.searchsorted(off, at, "right") - 1)
        end = raw.find(b"-----END ", at, int(off[r + 1]))
        end = raw.find(b"-----", end + 9, int(off[r + 1])) + 5 if end >= 0 else -1
        if end >= 5 and b"PRIVATE KEY" in raw[at : at + 60]:
            found.append((r, at, end))
        at = raw.find(b"-----BEGIN ", at + 11)
    blocks_of = list(found)
    blocks = np.array([(a, z) for _, a, z in found], np.int64).reshape(-1, 2)
    if len(blocks) and len(starts):
        i = np.searchsorted(blocks[:, 0], starts, "right") - 1
        free = (i < 0) | (starts >= blocks[np.maximum(i, 0), 1])
        starts, ends, row = starts[free], ends[free], row[free]
    for r, a, z in zip(row.tolist(), starts.tolist(), ends.tolist(), strict=True):
        while z > a and raw[z - 1 : z] in (b".", b"-", b"*"):
            z -= 1
        if z - a >= LEAST:
            found.append((r, a, z))
    out = {(r, a - int(off[r]), z - int(off[r])) for r, a, z in found}
    inside = {}
    for r, a, z in blocks_of:
        inside.setdefault(r, []).append((a - int(off[r]), z - int(off[r])))
    for r in range(len(off) - 1):
        text, at = raw[off[r] : off[r + 1]], 0
        while m := _ASSIGNED.search(text, at):
            a, z = m.span(m.lastindex)
            at = a  # a value may itself hold an assignment
            while z > a + 1 and text[z - 1 : z] in (b".", b",", b";"):
                z -= 1
            if not any(x < z and a < y for x, y in inside.get(r, ())):
                out.add((r, a, z))
    return sorted(out)


def _found(column, paths: list[str | None], forest: Forest) -> tuple[list[tuple[int, int, int]], np.ndarray, list[bytes]]:
    spans = candidates(column)
    texts = column.to_pylist()
    raws, x, values = {}, [], []
    for r, a, z in spans:
        if r not in raws:
            raws[r] = texts[r].encode()
        raw = raws[r]
        values.append(raw[a:z])
        x.append(features(raw[a:z].decode(), raw[max(0, a - AROUND) : a].decode("utf-8", "ignore"), raw[z : z + AROUND].decode("utf-8", "ignore"), paths[r] or ""))
    return spans, forest.predict(np.array(x)) if x else np.zeros(0), values


def scan(docs: DataFrame, forest: Forest, path: str | None = "source") -> DataFrame:
    """``(doc_id, start, length, score, is_secret, value_sha256)`` of every candidate; bytes of the UTF-8 text, the value only as a digest."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(forest)

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.pieces(batch):
                spans, score, values = _found(part.column("text"), part.column("path").to_pylist(), shared.value)
                at = pa.array([r for r, _, _ in spans], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), pa.array([a for _, a, _ in spans], pa.int64()), pa.array([z - a for _, a, z in spans], pa.int64()), pa.array(score), pa.array(score >= THRESHOLD), pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())],
                    ["doc_id", "start", "length", "score", "is_secret", "value_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, score double, is_secret boolean, value_sha256 string")


def redact(docs: DataFrame, forest: Forest, path: str | None = "source", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every confirmed secret of ``text`` replaced by ``mark``; all rows and columns stay."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(forest)
    # Columns go by their place, as their names may be any.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names, own = plain.columns, dict(zip(docs.columns, plain.columns, strict=True))

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.pieces(batch, own["text"]):
                column = part.column(own["text"])
                paths = part.column(own[path]).to_pylist() if path else [None] * part.num_rows
                spans, score, _ = _found(column, [None if p is None else str(p) for p in paths], shared.value)
                hits: dict[int, list[tuple[int, int]]] = {}
                for (r, a, z), s in zip(spans, score, strict=True):
                    if s >= THRESHOLD:
                        hits.setdefault(r, []).append((a, z))
                if hits:
                    texts = column.to_pylist()
                    for r, cuts in hits.items():
                        raw, at, out = texts[r].encode(), 0, []
                        for a, z in cuts:
                            if a >= at:
                                out += [raw[at:a], mark.encode()]
                            at = max(at, z)
                        texts[r] = b"".join([*out, raw[at:]]).decode()
                    column = pa.array(texts, column.type)
                yield pa.RecordBatch.from_arrays([column if c == own["text"] else part.column(c) for c in names], names)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
