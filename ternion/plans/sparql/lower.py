"""Lowering SPARQL trees to DataFrames.

A solution column holds one term as a string: ``I`` and an IRI, ``B`` and a label, or ``L``, datatype, U+0001,
language, U+0001 and the lexical form. Term equality is string equality, so joins are plain equi-joins;
expressions look inside. Patterns with constants become filters on the triples' own columns and reach the
scan. Joins follow shared variables; only where a shared variable may be unbound (it comes from OPTIONAL or
from one side of a UNION) is the compatibility join used.

Errors are SQL nulls: FILTER drops them, ``&&`` and ``||`` follow three-valued logic, IF on an error is an
error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ternion.operators.closure import reaching, transitive_closure
from ternion.plans.lineage import cut
from ternion.plans.sparql.parser import XSD, Query, parse
from ternion.schema import GRAPH

_SEP = "\u0001"
#: Bytes of written solutions up to which the next pattern is joined with them still held.
HELD = 8 * 2**20
_NUMERIC = [XSD + x for x in ("integer", "decimal", "double", "float", "int", "long", "short", "byte", "nonNegativeInteger", "positiveInteger")]
_AGGREGATES = {"COUNT", "SUM", "MIN", "MAX", "AVG", "SAMPLE", "GROUP_CONCAT"}


def literal(lex: Column, datatype: str = XSD + "string") -> Column:
    """The term of a literal."""
    return F.concat(F.lit("L" + datatype + _SEP + _SEP), lex)


def lexical(t: Column) -> Column:
    """STR(): the IRI, label or lexical form."""
    return F.when(t.startswith("L"), F.regexp_extract(t, f"(?s)^L[^{_SEP}]*{_SEP}[^{_SEP}]*{_SEP}(.*)$", 1)).otherwise(F.substring(t, 2, 2**31 - 1))


def datatype(t: Column) -> Column:
    return F.when(t.startswith("L"), F.regexp_extract(t, f"^L([^{_SEP}]*){_SEP}", 1))


def language(t: Column) -> Column:
    return F.when(t.startswith("L"), F.regexp_extract(t, f"^L[^{_SEP}]*{_SEP}([^{_SEP}]*){_SEP}", 1))


def number(t: Column) -> Column:
    """The value of a numeric literal, else null."""
    return F.when(datatype(t).isin(_NUMERIC), lexical(t).try_cast("double"))


@dataclass
class Value:
    """An expression's value in the form it was made in."""

    term_: Column | None = None
    bool_: Column | None = None
    num_: Column | None = None

    def term(self) -> Column:
        if self.term_ is not None:
            return self.term_
        if self.bool_ is not None:
            return literal(F.lower(self.bool_.cast("string")), XSD + "boolean")
        whole = self.num_ == F.floor(self.num_)
        return F.when(whole, literal(self.num_.cast("long").cast("string"), XSD + "integer")).otherwise(literal(self.num_.cast("string"), XSD + "decimal"))

    def num(self) -> Column:
        return self.num_ if self.num_ is not None else number(self.term())

    def bool(self) -> Column:
        if self.bool_ is not None:
            return self.bool_
        if self.num_ is not None:
            return self.num_ != 0
        t = self.term_
        kind = datatype(t)
        return F.when(kind == XSD + "boolean", lexical(t).isin("true", "1")).when(kind.isin(_NUMERIC), number(t) != 0).when(kind == XSD + "string", lexical(t) != "")

    def str(self) -> Column:
        return lexical(self.term())


@dataclass
class Plan:
    """Solutions, their variables, and which of these may be unbound."""

    df: DataFrame
    vars: set[str]
    loose: set[str] = field(default_factory=set)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


class Engine:
    """Queries over ``triples(s, p, o, o_kind, datatype, lang)``: IRIs or blank labels (``_:``) in s, IRIs in p.

    ``parts`` may give the rows of every predicate apart: a pattern with a constant predicate then reads that part alone,
    and its plan holds no other. Without ``parts`` it filters all triples.
    """

    def __init__(self, triples: DataFrame | None = None, parts: dict[str, DataFrame] | None = None):
        self.parts = parts
        self._all = triples

    @property
    def triples(self) -> DataFrame:
        if self._all is None:
            for x in self.parts.values():
                self._all = x if self._all is None else self._all.unionByName(x)
        return self._all

    def _of(self, predicate: str) -> DataFrame:
        """The triples of a predicate."""
        if self.parts is None:
            return self.triples.where(F.col("p") == predicate)
        if predicate in self.parts:
            return self.parts[predicate]
        return self._spark().createDataFrame([], GRAPH)

    def _spark(self) -> SparkSession:
        return (self._all if self._all is not None else next(iter(self.parts.values()))).sparkSession

    def query(self, text: str) -> DataFrame:
        """Solutions with the lexical form of each bound variable, null where unbound."""
        q = parse(text)
        plan = self._group(q.where)
        if q.form == "ASK":
            return plan.df.limit(1).agg((F.count(F.lit(1)) > 0).alias("ask"))
        return self._select(q, plan)

    def _select(self, q: Query, plan: Plan) -> DataFrame:
        df, scope = plan.df, plan.vars
        items = [(v, None) for v in sorted(x for x in scope if not x.startswith("_"))] if q.star else q.items
        if q.group or any(self._aggregates(e) for _, e in items if e) or q.having:
            return self._grouped(q, items, plan)
        order = []
        for k, (e, down) in enumerate(q.order):
            v = self._expr(e, scope).term()
            df = df.withColumn(f"__o{k}", self._order_class(v)).withColumn(f"__n{k}", number(v)).withColumn(f"__t{k}", lexical(v))
            for c in (f"__o{k}", f"__n{k}", f"__t{k}"):
                order.append(F.col(c).desc() if down else F.col(c).asc())
        out = [lexical(self._expr(e, scope).term() if e else _c(n) if n in scope else F.lit(None).cast("string")).alias(n) for n, e in items]
        if order:
            df = df.orderBy(*order)
        df = df.select(*out)
        return self._slice(q, df.distinct() if q.distinct else df)

    @staticmethod
    def _slice(q: Query, df: DataFrame) -> DataFrame:
        if q.offset:
            df = df.offset(q.offset)
        return df.limit(q.limit) if q.limit is not None else df

    @staticmethod
    def _order_class(t: Column) -> Column:
        return F.when(t.isNull(), 0).when(t.startswith("B"), 1).when(t.startswith("I"), 2).otherwise(3)

    def _aggregates(self, e: tuple) -> bool:
        return e[0] == "call" and (e[1] in _AGGREGATES or any(self._aggregates(a) for a in e[2] if a[0] != "all")) or e[0] in ("=", "!=", "<", ">", "<=", ">=", "&&", "||", "+", "-", "*", "/", "not") and any(self._aggregates(x) for x in e[1:])

    def _grouped(self, q: Query, items: list, plan: Plan) -> DataFrame:
        aggs: list[Column] = []
        known: dict[str, str] = {}

        def lift(e: tuple) -> tuple:
            if e[0] == "call" and e[1] in _AGGREGATES:
                key = repr(e)
                if key not in known:
                    known[key] = f"_agg{len(known)}"
                    aggs.append(self._aggregate(e, plan.vars).alias(known[key]))
                return ("var", known[key])
            if e[0] == "call":
                return ("call", e[1], [lift(a) for a in e[2]], e[3])
            return tuple(lift(x) if isinstance(x, tuple) else x for x in e) if e[0] not in ("lit", "iri", "var") else e

        lifted = [(n, lift(e) if e else None) for n, e in items]
        having, order = [lift(h) for h in q.having], [(lift(e), d) for e, d in q.order]
        df = plan.df.groupBy(*[_c(v) for v in q.group]).agg(*aggs) if aggs else plan.df.select(*[_c(v) for v in q.group]).distinct()
        scope = set(q.group) | set(known.values())
        for n, e in lifted:
            if e and n not in scope:
                df = df.withColumn(n, self._expr(e, scope).term())
                scope = scope | {n}
        for h in having:
            df = df.where(self._expr(h, scope).bool())
        inner = Query(items=[(n, None) for n, _ in lifted], distinct=q.distinct, order=order, limit=q.limit, offset=q.offset)
        return self._select(inner, Plan(df, scope))

    def _aggregate(self, e: tuple, scope: set[str]) -> Column:
        name, args, distinct = e[1], e[2], e[3]
        integer = lambda c: literal(c.cast("string"), XSD + "integer")
        if name == "COUNT":
            v = F.lit(1) if args[0][0] == "all" else self._expr(args[0], scope).term()
            return integer(F.count_distinct(v) if distinct else F.count(v))
        v = self._expr(args[0], scope)
        if name in ("SUM", "AVG"):
            x = v.num()
            got = F.sum_distinct(x) if distinct and name == "SUM" else {"SUM": F.sum, "AVG": F.avg}[name](x)
            return Value(num_=F.coalesce(got, F.lit(0.0))).term()
        if name in ("MIN", "MAX"):
            by = {"MIN": F.min, "MAX": F.max}[name]
            return by(F.struct(v.num().alias("n"), v.term().alias("t"))).getField("t")
        if name == "SAMPLE":
            return F.min(v.term())
        return literal(F.array_join(F.array_sort(F.collect_list(v.str())), " "))

    def _group(self, node: tuple, seeds: dict[str, DataFrame] | None = None) -> Plan | None:
        """A group's solutions. ``seeds`` holds values that variables must have for a solution to matter to the group around."""
        plan: Plan | None = None
        filters: list[tuple] = []
        triples: list[tuple] = []

        fixed = self._fixed(node)

        def flush() -> None:
            nonlocal plan
            held = bool(fixed or seeds)
            for part in self._ordered(triples, plan.vars if plan else set(), fixed, seeds or {}):
                plan = self._join(plan, part)
                if held:
                    plan, held = self._hold(plan)
            triples.clear()

        for part in node[1]:
            if part[0] == "triple":
                triples.append(part)
                continue
            if part[0] == "filter":
                filters.append(part[1])
                continue
            flush()
            if part[0] == "optional":
                plan = self._optional(plan, self._group(part[1]))
            elif part[0] == "union":
                inner = self._seeds(plan, fixed, node)
                plan = self._join(plan, self._union([self._group(g, inner) for g in part[1]]))
            elif part[0] == "group":
                plan = self._join(plan, self._group(part, self._seeds(plan, fixed, node)))
            elif part[0] == "bind":
                base = plan or Plan(self._spark().range(1).drop("id"), set())
                plan = Plan(base.df.withColumn(part[1], self._expr(part[2], base.vars).term()), base.vars | {part[1]}, base.loose | {part[1]})
            elif part[0] == "values":
                rows = self._spark().createDataFrame([(self._constant(t),) for t in part[2]], f"`{part[1]}` string")
                plan = self._join(plan, Plan(rows, {part[1]}))
            elif part[0] in ("exists", "minus"):
                other = self._group(part[1])
                shared = sorted(plan.vars & other.vars)
                if shared or part[0] == "exists":
                    kind = "left_semi" if part[0] == "exists" and part[2] else "left_anti"
                    right = other.df.select(*[_c(v).alias(f"__{v}") for v in shared]) if shared else other.df.limit(1)
                    on = None
                    for v in shared:
                        test = _c(v) == _c(f"__{v}")
                        if v in plan.loose or v in other.loose:
                            test = test | _c(v).isNull() | _c(f"__{v}").isNull()
                        on = test if on is None else on & test
                    plan = Plan(plan.df.join(right, on if on is not None else F.lit(True), kind), plan.vars, plan.loose)
        flush()
        plan = plan or Plan(self._spark().range(1).drop("id"), set())
        for f in filters:
            plan = Plan(plan.df.where(self._expr(f, plan.vars).bool()), plan.vars, plan.loose)
        return plan

    @staticmethod
    def _hold(plan: Plan) -> tuple[Plan, bool]:
        """The solutions so far, written, and whether they are few: the plan then knows it, and they go to the next pattern's triples, which stay where they are."""
        if not plan.vars:
            return plan, True
        df = cut(plan.df, "solutions")
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return Plan(df, plan.vars, plan.loose), size <= HELD

    @staticmethod
    def _fixed(node: tuple) -> dict[str, str]:
        """Variables whose lexical form a FILTER of the group fixes: ``STR(?v) = "text"``. Patterns may look for it before any join."""
        out = {}
        for part in node[1]:
            if part[0] == "filter" and part[1][0] == "=":
                for a, b in (part[1][1:], part[1][:0:-1]):
                    if a[0] == "call" and a[1] == "STR" and a[2][0][0] == "var" and b[0] == "lit":
                        out[a[2][0][1]] = b[1]
        return out

    def _seeds(self, plan: Plan | None, fixed: dict[str, str], node: tuple) -> dict[str, DataFrame]:
        """Where filters fix variables of the group so far: the values of the subjects that they describe, for the groups within."""
        if plan is None or not fixed:
            return {}
        described = {t[1][1] for t in node[1] if t[0] == "triple" and t[1][0] == "var" and t[3][0] == "var" and t[3][1] in fixed}
        return {v: cut(plan.df.select(_c(v).alias("seed")).distinct(), "seeds") for v in sorted((described & plan.vars) - plan.loose)}

    def _ordered(self, triples: list[tuple], bound: set[str], fixed: dict[str, str], seeds: dict[str, DataFrame]) -> list[Plan]:
        """Patterns so that each shares a variable with those before it where any does; those with values that are sought first, then most constants."""
        left, seen, out = list(triples), set(bound), []
        names = lambda t: {x[1] for x in (t[1], t[3]) if x[0] == "var"} | ({t[2][1]} if t[2][0] == "var" else set())
        while left:
            sought = lambda x: x[0] == "var" and (x[1] in fixed or x[1] in seeds)
            known = lambda x: x[0] != "var" or sought(x)
            best = max(left, key=lambda t: (bool(names(t) & seen) or not seen, sought(t[1]) or sought(t[3]), known(t[1]) + known(t[3]), t[2][0] == "iri", -left.index(t)))
            left.remove(best)
            seen |= names(best)
            found = self._pattern(best, fixed)
            for v in sorted(names(best) & set(seeds)):
                found = Plan(found.df.join(seeds[v], _c(v) == F.col("seed"), "left_semi"), found.vars)
            out.append(found)
        return out

    @staticmethod
    def _constant(t: tuple) -> str:
        return "I" + t[1] if t[0] == "iri" else f"L{t[2]}{_SEP}{t[3]}{_SEP}{t[1]}"

    @staticmethod
    def _subject(c: Column) -> Column:
        return F.when(c.startswith("_:"), F.concat(F.lit("B"), F.substring(c, 3, 2**31 - 1))).otherwise(F.concat(F.lit("I"), c))

    @staticmethod
    def _object() -> Column:
        return (
            F.when(F.col("o_kind") == "iri", F.concat(F.lit("I"), F.col("o")))
            .when(F.col("o_kind") == "bnode", F.concat(F.lit("B"), F.regexp_replace("o", "^_:", "")))
            .otherwise(F.concat(F.lit("L"), F.coalesce("datatype", F.lit("")), F.lit(_SEP), F.coalesce("lang", F.lit("")), F.lit(_SEP), F.col("o")))
        )

    def _pattern(self, t: tuple, fixed: dict[str, str]) -> Plan:
        _, s, p, o = t
        if p[0] not in ("iri", "var"):
            rel = self._path(p, s, o)
        else:
            df = self._of(p[1]) if p[0] == "iri" else self.triples
            if s[0] == "iri":
                df = df.where(F.col("s") == s[1])
            if o[0] == "iri":
                df = df.where((F.col("o") == o[1]) & (F.col("o_kind") == "iri"))
            elif o[0] == "lit":
                df = df.where((F.col("o") == o[1]) & (F.col("o_kind") == "literal") & (F.coalesce("datatype", F.lit("")) == o[2]) & (F.coalesce("lang", F.lit("")) == o[3]))
            elif o[1] in fixed:
                df = df.where((F.col("o") == fixed[o[1]]) | (F.col("o_kind") == "bnode"))
            if s[0] == "var" and s[1] in fixed:
                df = df.where((F.col("s") == fixed[s[1]]) | F.col("s").startswith("_:"))
            rel = df.select(self._subject(F.col("s")).alias("__s"), F.concat(F.lit("I"), F.col("p")).alias("__p"), self._object().alias("__o"))
        cols: dict[str, Column] = {}
        for x, c in ((s, "__s"), (p, "__p"), (o, "__o")):
            if x[0] == "var":
                if x[1] in cols:
                    rel = rel.where(cols[x[1]] == F.col(c))
                else:
                    cols[x[1]] = F.col(c)
        return Plan(rel.select(*[c.alias(n) for n, c in cols.items()]), set(cols))

    def _path(self, p: tuple, s: tuple = ("var", ""), o: tuple = ("var", "")) -> DataFrame:
        """The pairs ``(__s, __o)`` of a path, with constant ends applied. A constant behind ``*`` or ``+`` is searched from, backwards."""
        if o[0] == "iri" and p[0] == "seq" and p[1][-1][0] in ("star", "plus"):
            first, last = p[1][:-1], p[1][-1]
            edges = self._pairs(last[1])
            goal = self._spark().createDataFrame([(self._constant(o),)], "node string")
            if last[0] == "plus":
                goal = edges.join(goal, edges["__o"] == goal["node"], "left_semi").select(F.col("__s").alias("node"))
            found = reaching(edges, goal, "__s", "__o").select(F.col("node").alias("__o"))
            rel = self._pairs(first[0] if len(first) == 1 else ("seq", first)).join(found, "__o", "left_semi").select("__s", F.lit(self._constant(o)).alias("__o"))
            if s[0] in ("iri", "lit"):
                rel = rel.where(F.col("__s") == self._constant(s))
            return rel
        rel = self._pairs(p)
        for x, c in ((s, "__s"), (o, "__o")):
            if x[0] in ("iri", "lit"):
                rel = rel.where(F.col(c) == self._constant(x))
        return rel

    def _pairs(self, p: tuple) -> DataFrame:
        kind = p[0]
        if kind == "iri":
            return self._of(p[1]).select(self._subject(F.col("s")).alias("__s"), self._object().alias("__o"))
        if kind == "inv":
            return self._pairs(p[1]).select(F.col("__o").alias("__s"), F.col("__s").alias("__o"))
        if kind == "alt":
            out = self._pairs(p[1][0])
            for x in p[1][1:]:
                out = out.unionByName(self._pairs(x))
            return out
        if kind == "seq":
            out = self._pairs(p[1][0])
            for x in p[1][1:]:
                mid = out.select("__s", F.col("__o").alias("__m"))
                if x[0] in ("star", "maybe"):
                    more = self._reach(x).where("__s <> __o").select(F.col("__s").alias("__m"), "__o")
                    out = mid.select("__s", F.col("__m").alias("__o")).unionByName(mid.join(more, "__m").select("__s", "__o"))
                else:
                    out = mid.join(self._pairs(x).select(F.col("__s").alias("__m"), "__o"), "__m").select("__s", "__o")
            return out
        if kind == "plus":
            return self._reach(p)
        nodes = self.triples.select(self._subject(F.col("s")).alias("__s")).union(self.triples.select(self._object())).distinct()
        return nodes.select("__s", F.col("__s").alias("__o")).unionByName(self._reach(p)).distinct()

    def _reach(self, p: tuple) -> DataFrame:
        edges = self._pairs(p[1])
        if p[0] == "maybe":
            return edges.distinct()
        return transitive_closure(edges, "__s", "__o").select(F.col("src").alias("__s"), F.col("dst").alias("__o"))

    def _join(self, left: Plan | None, right: Plan, how: str = "inner") -> Plan:
        if left is None:
            return right
        shared = sorted(left.vars & right.vars)
        loose = [v for v in shared if v in left.loose or v in right.loose]
        kept = left.loose | right.loose if how == "inner" else left.loose | (right.vars - left.vars)
        if not shared:
            joined = left.df.crossJoin(right.df) if how == "inner" else left.df.join(right.df, F.lit(True), how)
            return Plan(joined, left.vars | right.vars, kept)
        if not loose:
            return Plan(left.df.join(right.df, shared, how), left.vars | right.vars, kept - (set(shared) if how == "inner" else set()))
        other = right.df.select(*[_c(v).alias(f"__r_{v}" if v in shared else v) for v in right.vars])
        on = None
        for v in shared:
            test = _c(v) == _c(f"__r_{v}")
            if v in loose:
                test = test | _c(v).isNull() | _c(f"__r_{v}").isNull()
            on = test if on is None else on & test
        df = left.df.join(other, on, how)
        cols = [F.coalesce(_c(v), _c(f"__r_{v}")).alias(v) if v in loose else _c(v) for v in left.vars] + [_c(v) for v in right.vars - left.vars]
        return Plan(df.select(*cols), left.vars | right.vars, kept)

    def _optional(self, left: Plan | None, right: Plan) -> Plan:
        base = left or Plan(self._spark().range(1).drop("id"), set())
        return self._join(base, right, "left")

    @staticmethod
    def _union(sides: list[Plan]) -> Plan:
        every = set().union(*(x.vars for x in sides))
        loose = set().union(*(x.loose for x in sides)) | {v for v in every if any(v not in x.vars for x in sides)}
        names = sorted(every)
        df = None
        for x in sides:
            part = x.df.select(*[_c(v) if v in x.vars else F.lit(None).cast("string").alias(v) for v in names])
            df = part if df is None else df.unionByName(part)
        return Plan(df, every, loose)

    def _expr(self, e: tuple, scope: set[str]) -> Value:
        kind = e[0]
        if kind == "var":
            return Value(term_=_c(e[1]) if e[1] in scope else F.lit(None).cast("string"))
        if kind in ("iri", "lit"):
            return Value(term_=F.lit(self._constant(e)))
        if kind == "not":
            return Value(bool_=~self._expr(e[1], scope).bool())
        if kind in ("&&", "||"):
            a, b = (self._expr(x, scope).bool() for x in e[1:])
            return Value(bool_=a & b if kind == "&&" else a | b)
        if kind in ("+", "-", "*", "/"):
            a, b = (self._expr(x, scope).num() for x in e[1:])
            return Value(num_={"+": a + b, "-": a - b, "*": a * b, "/": F.try_divide(a, b)}[kind])
        if kind in ("=", "!=", "<", ">", "<=", ">="):
            return Value(bool_=self._compare(kind, self._expr(e[1], scope), self._expr(e[2], scope)))
        return self._call(e[1], e[2], scope)

    @staticmethod
    def _compare(op: str, a: Value, b: Value) -> Column:
        x, y = a.num(), b.num()
        ta, tb_ = a.term(), b.term()
        both = x.isNotNull() & y.isNotNull()
        if op in ("=", "!="):
            same = F.when(both, x == y).otherwise(ta == tb_)
            return same if op == "=" else ~same
        test = {"<": lambda p, q: p < q, ">": lambda p, q: p > q, "<=": lambda p, q: p <= q, ">=": lambda p, q: p >= q}[op]
        return F.when(both, test(x, y)).when(datatype(ta) == datatype(tb_), test(lexical(ta), lexical(tb_)))

    def _call(self, name: str, args: list[tuple], scope: set[str]) -> Value:
        if name == "BOUND":
            return Value(bool_=_c(args[0][1]).isNotNull() if args[0][1] in scope else F.lit(False))
        v = [self._expr(a, scope) for a in args]
        if name == "IF":
            c = v[0].bool()
            return Value(term_=F.when(c, v[1].term()).when(~c, v[2].term()))
        if name == "COALESCE":
            return Value(term_=F.coalesce(*[x.term() for x in v]))
        if name == "STR":
            return Value(term_=literal(v[0].str()))
        if name == "CONCAT":
            return Value(term_=literal(F.concat(*[x.str() for x in v])))
        if name in ("LCASE", "UCASE"):
            return Value(term_=literal((F.lower if name == "LCASE" else F.upper)(v[0].str())))
        if name == "STRLEN":
            return Value(num_=F.char_length(v[0].str()).cast("double"))
        if name in ("CONTAINS", "STRSTARTS", "STRENDS"):
            return Value(bool_={"CONTAINS": F.contains, "STRSTARTS": F.startswith, "STRENDS": F.endswith}[name](v[0].str(), v[1].str()))
        if name == "REGEX":
            pattern = v[1].str() if len(v) < 3 else F.concat(F.lit("(?"), v[2].str(), F.lit(")"), v[1].str())
            return Value(bool_=F.regexp_like(v[0].str(), pattern))
        if name == "LANG":
            return Value(term_=literal(language(v[0].term())))
        if name == "DATATYPE":
            return Value(term_=F.concat(F.lit("I"), datatype(v[0].term())))
        if name in ("ISIRI", "ISURI", "ISLITERAL", "ISBLANK"):
            return Value(bool_=v[0].term().startswith({"ISIRI": "I", "ISURI": "I", "ISLITERAL": "L", "ISBLANK": "B"}[name]))
        raise ValueError(f"unknown function {name}")


def to_rows(df: DataFrame, most: int | None = None) -> list[dict[str, str]]:
    """Rows for a tool call: strings, ``"None"`` where unbound. ``most`` caps them (an agent sees ten)."""
    rows = (df.limit(most) if most is not None else df).collect()
    return [{k: str(v) for k, v in r.asDict().items()} for r in rows]


def tool_query(engine: Engine, text: str, most: int | None = 10) -> list[dict[str, str]]:
    """`to_rows` of a query; an error becomes one row that says so."""
    try:
        return to_rows(engine.query(text), most)
    except Exception as e:  # the agent is told whatever went wrong
        return [{"error": str(e)}]
