"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain, language, source. A node's capacity is the tokens below it times the number of
epochs allowed. From the root down each node's budget is shared among its children by their target
weights; a child gets at most its capacity, and what it cannot take goes to its siblings in
proportion to their weights. As a node never gets more than the capacity below it, a shortage rises
to an ancestor only when all siblings are full. Each leaf then takes whole epochs and a prefix, in
the seeded order of the last epoch, of at most the tokens left.

Only sums by leaf reach the driver: one row for each (domain, language, source). The prefix of a
leaf is found by sums over 256 ranges of the order's hash, then over 256 parts of the one range
where the budget ends, and so on, LEVELS times; only the rows of the last range (of a leaf's 16
million) are put in order, so no task ever sorts a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import read, written

#: Times that the range where a budget ends is cut into 256.
LEVELS = 3
NAMES = ("domain", "language", "source")


@dataclass(frozen=True)
class Targets:
    """Relative weights of the children of every node by their name, 1 for names without one; total tokens wanted, or their share of all tokens."""

    weights: tuple[dict[str, float], dict[str, float], dict[str, float]] = field(default_factory=lambda: ({}, {}, {}))
    tokens: int | None = None
    share: float = 0.5
    epochs: int = 2
    seed: int = 17


#: What the query and the pipeline ask for. A source's domain is its number modulo three.
QUERY_TARGETS = Targets(({"d0": 5.0, "d1": 3.0, "d2": 2.0}, {"en": 4.0, "fr": 2.0, "de": 2.0, "es": 2.0}, {}), share=0.6, epochs=3)
PIPELINE_TARGETS = Targets(({"d0": 5.0, "d1": 3.0, "d2": 2.0}, {"en": 4.0, "fr": 2.0, "de": 2.0, "es": 2.0}, {}), share=0.9, epochs=1)


def domain_of(source):
    """d0, d1 or d2 by the number in a source's name; ``other`` without one."""
    digits = F.regexp_extract(source, r"(\d{1,9})", 1)
    return F.when(digits != "", F.concat(F.lit("d"), (digits.cast("long") % 3).cast("string"))).otherwise(F.lit("other"))


def shared_out(budget: int, children: list[tuple[str, float, int]]) -> dict[str, int]:
    """A budget among children (name, weight, capacity): in proportion to weights up to capacities, whole tokens, the whole of what can be given."""
    out = {name: 0 for name, _, _ in children}
    budget = min(budget, sum(c for _, _, c in children))
    open_ = sorted((c / w, name, w, c) for name, w, c in children if w > 0 and c > 0)
    weight = sum(x[2] for x in open_)
    for at, (_, name, w, c) in enumerate(open_):  # those soonest full first: what they leave raises the others' shares
        last = at == len(open_) - 1
        out[name] = min(c, budget if last else int(budget * w / weight))
        budget -= out[name]
        weight -= w
    for name, w, c in sorted(children):  # weight 0, or a token left by rounding: only where nothing else can take it
        more = min(budget, c - out[name]) if w > 0 else 0
        out[name] += more
        budget -= more
    return out


def budgets(leaves: list[tuple[str, str, str, int]], targets: Targets) -> dict[tuple[str, str, str], int]:
    """Tokens of each leaf (domain, language, source, tokens)."""
    total = sum(x[3] for x in leaves)
    wanted = targets.tokens if targets.tokens is not None else int(total * targets.share)

    def down(prefix: tuple[str, ...], budget: int) -> dict[tuple[str, str, str], int]:
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        below: dict[str, int] = {}
        for *path, tokens in leaves:
            if tuple(path[:depth]) == prefix:
                below[path[depth]] = below.get(path[depth], 0) + tokens * targets.epochs
        given = shared_out(budget, [(n, targets.weights[depth].get(n, 1.0), c) for n, c in sorted(below.items())])
        return {k: v for n, b in given.items() for k, v in down((*prefix, n), b).items()}

    return down((), wanted)


def count_tokens(text):
    """Runs of [^\\x20\\x09-\\x0D]; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def _order_key(seed: int):
    """The seeded order within an epoch, as hexadecimal digits; a row without doc_id goes by its text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))
    return lambda epoch: F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col("name")).cast("binary")), name


def _prefixes(part: DataFrame, leaf: list[str]) -> list[DataFrame]:
    """Of the rows of part (leaf, key, tie, tokens, rest) those that stand, in the order of key and tie, within the first `rest` tokens of their leaf."""
    taken, left = [], part
    for level in range(LEVELS):
        left = left.withColumn("bucket", F.conv(F.substring("key", 1 + 2 * level, 2), 16, 10).cast("int"))
        sums = left.groupBy(*leaf, "bucket").agg(F.sum("tokens").alias("in_bucket"), F.max("rest").alias("rest"))  # at most 256 rows for each leaf
        through = F.sum("in_bucket").over(Window.partitionBy(*leaf).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ends = sums.withColumn("through", through).where("through > rest")
        ends = ends.groupBy(*leaf).agg(F.min("bucket").alias("end_bucket"), F.min_by(F.col("through") - F.col("in_bucket"), "bucket").alias("before"))
        left = left.join(F.broadcast(ends), leaf, "left")  # one row for each leaf
        taken.append(left.where("end_bucket is null or bucket < end_bucket").select(*part.columns))
        left = left.where("bucket = end_bucket").withColumn("rest", F.col("rest") - F.col("before")).select(*part.columns)
        # Few rows, read again by the next level and the last.
        left = written(left, "end-bucket")
    inside = F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return [*taken, left.withColumn("until", inside).where("until <= rest").select(*part.columns)]


def mix(docs: DataFrame, targets: Targets, language: str = "lang") -> DataFrame:
    """The rows of docs (doc_id, text, lang, source) that the mixture takes, each once for every epoch it is taken in.

    Returns the columns of docs and epoch (from 1), tokens. Rows without words, null and empty texts
    among them, cost nothing and are taken while any budget of their leaf is left, as the order has
    them; a text of any length is taken whole or not at all. A null language or source is the leaf
    ``none``. Rows that share a doc_id stand together in the order, by the hash of their text; rows
    alike in doc_id, text and leaf are one unit, which costs what all of them have and is taken
    whole, so no leaf exceeds its budget. Rows without doc_id are ordered by their texts. Columns
    of docs named like a result or a working column (epoch, tokens, domain, language, leaf_source,
    key, bucket) give way, others pass through. An empty table gives an empty result.
    """
    mine = ["epoch", "tokens", "domain", "language", "leaf_source", "key", "bucket"]
    docs = docs.drop(*(x for x in mine if x not in (language,)))
    names = docs.columns
    path = {"domain": domain_of(F.coalesce(F.col("source"), F.lit(""))), "language": F.coalesce(F.col(language), F.lit("none")), "leaf_source": F.coalesce(F.col("source"), F.lit("none"))}
    key, name = _order_key(targets.seed)
    sizes = docs.select("doc_id", name.alias("name"), *(c.alias(n) for n, c in path.items()), count_tokens(F.col("text").cast("string")).alias("tokens"), F.xxhash64("text").alias("tie"))
    leaf = list(path)
    unit = ["doc_id", "tie", *leaf]
    sizes = written(sizes.groupBy(*unit).agg(F.min("name").alias("name"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("each")), "sizes")
    leaves = [tuple(r) for r in sizes.groupBy(*leaf).agg(F.sum("tokens")).collect()]  # one row for each leaf
    given = budgets(leaves, targets)
    plan = []
    for d, l, s, tokens in leaves:
        full, rest = divmod(given[(d, l, s)], tokens) if tokens else (0, 0)
        plan.append((d, l, s, int(full), int(rest)))
    spark = docs.sparkSession
    plan_df = F.broadcast(spark.createDataFrame(plan, "domain string, language string, leaf_source string, full_epochs int, rest long"))  # one row for each leaf
    placed = sizes.join(plan_df, leaf)
    part = placed.where("rest > 0").withColumn("epoch", F.col("full_epochs") + 1).withColumn("key", key(F.col("epoch")))
    part = part.select(*unit, "key", "epoch", "tokens", "each", "rest")
    whole = placed.where("full_epochs > 0").select(*unit, "each", F.explode(F.expr("sequence(1, full_epochs)")).alias("epoch"))
    chosen = whole
    for some in _prefixes(part, leaf):
        chosen = chosen.union(some.select(*unit, "each", "epoch"))
    of = {x: f"__{x}" for x in unit}
    chosen = chosen.groupBy(*(F.col(x).alias(y) for x, y in of.items())).agg(F.sort_array(F.collect_set("epoch")).alias("__epochs"), F.max("each").alias("tokens"))
    own = {"doc_id": F.col("doc_id"), "tie": F.xxhash64("text"), **path}
    same = [own[x].eqNullSafe(F.col(y)) if x == "doc_id" else own[x] == F.col(y) for x, y in of.items()]
    found = docs.join(chosen, reduce(and_, same))
    return found.select(*names, F.explode("__epochs").alias("epoch"), "tokens")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, epoch, tokens, source, lang of the rows taken from the whole documents table."""
    return mix(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), QUERY_TARGETS).select("doc_id", "epoch", "tokens", "source", "lang")


def _level_sql(k: int) -> str:
    """Budgets of the nodes below kids{k} (p, name, w, cap) from above{k} (p, budget), one child after the other as shared_out() has them."""
    return f"""
open{k} AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY cap / w, name) AS rn, count(*) OVER (PARTITION BY p) AS n FROM kids{k} WHERE w > 0 AND cap > 0),
start{k} AS (SELECT o.p, least(any_value(a.budget), CAST(sum(o.cap) AS BIGINT)) AS budget, sum(o.w) AS weight FROM open{k} o JOIN above{k} a ON a.p = o.p GROUP BY o.p),
walk{k} AS (
  SELECT p, CAST(0 AS BIGINT) AS rn, '' AS name, budget, weight, CAST(0 AS BIGINT) AS given, CAST(0 AS BIGINT) AS slack FROM start{k}
  UNION ALL
  SELECT p, rn, name, budget - g, weight - w, g, cap - g FROM (
    SELECT o.p, o.rn, o.name, o.w, o.cap, x.budget, x.weight,
           least(o.cap, CASE WHEN o.rn = o.n THEN x.budget ELSE CAST(trunc(x.budget * o.w / x.weight) AS BIGINT) END) AS g
    FROM walk{k} x JOIN open{k} o ON o.p = x.p AND o.rn = x.rn + 1)
), left{k} AS (SELECT p, arg_max(budget, rn) AS more FROM walk{k} GROUP BY p),
given{k} AS (
  SELECT x.p, x.name, x.given + least(x.slack, greatest(0, l.more - coalesce(CAST(sum(x.slack) OVER (PARTITION BY x.p ORDER BY x.name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))) AS budget
  FROM walk{k} x JOIN left{k} l ON l.p = x.p WHERE x.rn > 0
)"""


def _weights_sql(weights: dict[str, float], column: str) -> str:
    return f"CAST(CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END AS DOUBLE)" if weights else "CAST(1 AS DOUBLE)"


def mixture_sql(t: Targets) -> str:
    d, l, s = (_weights_sql(w, c) for w, c in zip(t.weights, ("domain", "language", "leaf_source"), strict=True))
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS tokens,
         CASE WHEN regexp_extract(coalesce(source, ''), '\d+') = '' THEN 'other' ELSE 'd' || (CAST(regexp_extract(source, '\d+') AS BIGINT) % 3) END AS domain,
         coalesce(lang, 'none') AS language, coalesce(source, 'none') AS leaf_source FROM documents
), leaves AS (SELECT domain, language, leaf_source, CAST(sum(tokens) AS BIGINT) AS t FROM docs GROUP BY ALL),
above1 AS (SELECT '' AS p, CAST(trunc(CAST(sum(t) AS BIGINT) * CAST({t.share} AS DOUBLE)) AS BIGINT) AS budget FROM leaves),
kids1 AS (SELECT '' AS p, domain AS name, {d} AS w, CAST(sum(t) AS BIGINT) * {t.epochs} AS cap FROM leaves GROUP BY domain),{_level_sql(1)},
above2 AS (SELECT name AS p, budget FROM given1),
kids2 AS (SELECT domain AS p, language AS name, {l} AS w, CAST(sum(t) AS BIGINT) * {t.epochs} AS cap FROM leaves GROUP BY domain, language),{_level_sql(2)},
above3 AS (SELECT p || '|' || name AS p, budget FROM given2),
kids3 AS (SELECT domain || '|' || language AS p, leaf_source AS name, {s} AS w, t * {t.epochs} AS cap FROM leaves),{_level_sql(3)},
plan AS (SELECT l.*, CASE WHEN t > 0 THEN coalesce(g.budget, 0) // t ELSE 0 END AS full_epochs, CASE WHEN t > 0 THEN coalesce(g.budget, 0) % t ELSE 0 END AS rest
         FROM leaves l LEFT JOIN given3 g ON g.p = l.domain || '|' || l.language AND g.name = l.leaf_source),
placed AS (SELECT d.*, p.full_epochs, p.rest FROM docs d JOIN plan p ON p.domain = d.domain AND p.language = d.language AND p.leaf_source = d.leaf_source),
part AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, leaf_source ORDER BY md5('{t.seed}:' || (full_epochs + 1) || ':' || doc_id)) AS until FROM placed WHERE rest > 0)
SELECT doc_id, CAST(full_epochs + 1 AS INTEGER) AS epoch, tokens, source, lang FROM part WHERE until <= rest
UNION ALL
SELECT doc_id, CAST(unnest(range(1, full_epochs + 1)) AS INTEGER) AS epoch, tokens, source, lang FROM placed WHERE full_epochs > 0
"""


ORACLE_SQL = mixture_sql(QUERY_TARGETS)
