"""Mixing sources to target weights by hierarchical budgeting.

Documents are leaves' members of a tree (domain, language, source).  A token
budget flows down the tree: each node gives its children shares in proportion
to their weights.  A child that cannot use its share (its tokens times the
greatest number of epochs) is filled and the shortage goes to its siblings; only
if all of them are full does less reach the node, so that what is left goes to
the node's own siblings.  Each leaf then takes whole epochs of its documents and
the token-prefix of one more epoch in an order seeded by (seed, epoch).

Of a group of siblings, ``limit`` = the greatest ``(budget - capacity of those
that fill up first) / (weight of the others)`` is the level of the water: a
child gets ``min(capacity, weight * limit)``.  Window functions over the leaf
table give it; documents only meet one row for each leaf.

A leaf's prefix ends at one cut in the order of hashes.  It is found by sums
over 256 ranges of hashes, then over 256 parts of the range that holds the cut,
and a running sum inside one part, so a leaf that holds a third of all documents
is never summed in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir

LEVELS = ("domain", "lang", "source")
# The leaf table is broadcast up to this many rows and joined by shuffle beyond.
MAX_BROADCAST_LEAVES = 50_000
# Hexadecimal digits of the nested hash ranges.
RANGE_DIGITS = (2, 4)


@dataclass(frozen=True)
class Mix:
    """Targets: integer weights by level and name (``default`` for other names),
    the budget as a share of all tokens, and how often a document may be used."""

    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    default: dict[str, int] = field(default_factory=dict)
    budget_share: float = 1.0
    max_epochs: int = 4
    seed: int = 42

    def weight(self, level: str) -> Column:
        out = F.lit(self.default.get(level, 1))
        for name, value in sorted(self.weights.get(level, {}).items()):
            out = F.when(F.col(level) == name, F.lit(value)).otherwise(out)
        return out.cast("bigint")


def word_count(text: Column) -> Column:
    """Tokens of a whole text: runs of anything but ASCII white space."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))).cast("bigint")


def _filled(nodes: DataFrame, level: str, parents: list[str]) -> DataFrame:
    """Give the children of each parent their ``budget``: ``nodes`` has the key
    columns, ``w``, ``cap`` and the parent's budget ``given``."""
    order = Window.partitionBy(*parents, F.lit(0)).orderBy(F.col("cap") / F.col("w"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level_ = (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    ranked = nodes.withColumn("_l", level_).withColumn("_l", F.max("_l").over(Window.partitionBy(*parents, F.lit(0))))
    return ranked.withColumn("budget", F.least(
        F.col("cap"), F.greatest(F.lit(0).cast("bigint"), F.floor(F.col("w") * F.col("_l")))).cast("bigint")).drop("_l", "given")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``budget``, ``epochs`` (whole
    ones) and ``rest`` (tokens of one more).  Nodes of weight 0 get nothing."""
    rows = leaves.select(*LEVELS, "tokens")
    for level in LEVELS:
        rows = rows.withColumn(f"_w_{level}", mix.weight(level))
    live = rows.where(" AND ".join(f"_w_{level} > 0" for level in LEVELS)).withColumn(
        "cap", F.col("tokens") * mix.max_epochs)
    total = leaves.agg(F.sum("tokens").alias("t"))
    given = F.floor(total.select("t").scalar() * F.lit(mix.budget_share))
    parents: list[str] = []
    above: DataFrame | None = None
    for level in LEVELS:
        keys = [*parents, level]
        nodes = live.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.first(f"_w_{level}").alias("w"))
        if above is None:
            nodes = nodes.withColumn("given", F.least(given, F.sum("cap").over(Window.partitionBy(F.lit(0)))))
        else:
            nodes = nodes.join(above, parents)
        above = _filled(nodes, level, parents).select(*keys, F.col("budget").alias("given"))
        parents = keys
    found = live.select(*LEVELS, "tokens").join(above.withColumnRenamed("given", "budget"), list(LEVELS))
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0))
    return found.select("*", epochs.cast("bigint").alias("epochs")).select(
        "*", (F.col("budget") - F.col("epochs") * F.col("tokens")).alias("rest"))


def _order(mix: Mix, epoch: Column, key: Column) -> Column:
    """Place of a document in the order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def _meet(rows: DataFrame, leaves: DataFrame, small: bool) -> DataFrame:
    """Join on the leaf; the leaf table is broadcast only if its counted size allows."""
    return rows.join(F.broadcast(leaves) if small else leaves, [f"_{level}" for level in LEVELS])


def leaf_cuts(members: DataFrame, mix: Mix) -> tuple[DataFrame, bool]:
    """For each leaf (``_domain``, ``_lang``, ``_source``) its whole epochs and the
    last place of the prefix (null: none), checkpointed; and whether it is small.
    ``members`` has the leaf columns, ``_key`` and ``_tokens``."""
    names = [f"_{level}" for level in LEVELS]
    leaves = members.groupBy(*names).agg(F.sum("_tokens").alias("tokens"))
    leaves = leaves.select(*(F.col(n).alias(level) for n, level in zip(names, LEVELS)), "tokens").checkpoint()
    small = leaves.count() <= MAX_BROADCAST_LEAVES
    plan = leaf_budgets(leaves, mix).select(
        *(F.col(level).alias(n) for n, level in zip(names, LEVELS)), "budget", "epochs", "rest").checkpoint()
    inside = _meet(members, plan.where("rest > 0").drop("budget"), small).select(
        *names, "rest", "_tokens", _order(mix, F.col("epochs"), F.col("_key")).alias("_place"),
        F.lit(0).cast("bigint").alias("_before"))
    running = Window.partitionBy(*names)
    for digits in RANGE_DIGITS:
        # The range of places, by their leading digits, in which the prefix ends.
        ranges = inside.groupBy(*names, "rest", "_before", F.substring("_place", 1, digits).alias("_range")).agg(
            F.sum("_tokens").alias("_sum"))
        edge = (ranges.withColumn("_at", F.col("_before") + F.sum("_sum").over(running.orderBy("_range")) - F.col("_sum"))
                .where("_at < rest AND _at + _sum >= rest").select(*names, "_range", "_at"))
        inside = (_meet(inside.drop("_before"), edge, small)
                  .where(F.substring("_place", 1, digits) == F.col("_range"))
                  .select(*names, "rest", "_tokens", "_place", F.col("_at").alias("_before")))
    steps = inside.groupBy(*names, "rest", "_before", "_place").agg(F.sum("_tokens").alias("_sum"))
    cuts = (steps.withColumn("_at", F.col("_before") + F.sum("_sum").over(running.orderBy("_place")) - F.col("_sum"))
            .where("_at < rest").groupBy(*names).agg(F.max("_place").alias("_cut")))
    return plan.join(cuts, names, "left").checkpoint(), small


def with_copies(rows: DataFrame, mix: Mix, key: Column, levels: dict[str, Column], text: Column) -> DataFrame:
    """``rows`` with ``_epoch`` added: one row for each epoch (from 0) that uses it.

    ``levels`` maps domain, lang and source to expressions; null counts as
    ``unknown``.  A document's tokens are the words of its whole text; null texts
    and texts without words have none: they go along with every epoch that is
    used whole and with the prefix where their place is in it.  Rows that share
    a key in a leaf are used together.  All columns of ``rows`` are kept (names
    starting with ``_`` must not be among this module's own); an empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    checkpoint_dir(spark)
    names = [f"_{level}" for level in LEVELS]
    # One struct holds the input's columns, so none can clash.
    packed = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"), key.alias("_key"),
                         *(F.coalesce(levels[level], F.lit("unknown")).alias(n) for level, n in zip(LEVELS, names)),
                         word_count(text).alias("_tokens"))
    members = packed.select("_key", *names, "_tokens").checkpoint()
    cuts, small = leaf_cuts(members, mix)
    met = _meet(packed, cuts, small)
    within = F.coalesce(_order(mix, F.col("epochs"), F.col("_key")) <= F.col("_cut"), F.lit(False))
    uses = (F.col("epochs") + F.when(within, F.lit(1)).otherwise(F.lit(0))).cast("int")
    return met.withColumn("_uses", uses).where("_uses > 0").select(
        "_row", "_key", *names, "_tokens", F.explode(F.sequence(F.lit(0), F.col("_uses") - 1)).alias("_epoch"))


# Production targets of the registered query and of the pipeline.
DOMAINS = ("web", "books", "forum", "reference")
MIX = Mix(
    weights={"domain": {"web": 400, "books": 300, "reference": 200, "forum": 100},
             "lang": {"en": 550, "de": 150, "fr": 150, "es": 150}},
    default={"domain": 50, "lang": 50, "source": 1})


def document_levels() -> dict[str, Column]:
    """Tree place of a row of ``documents``: the domain follows from the source's number."""
    number = F.coalesce(F.regexp_extract("source", r"([0-9]+)", 1).try_cast("bigint"), F.lit(0))
    domain = F.element_at(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS) + 1).cast("int"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def mix_sql(mix: Mix = MIX) -> str:
    """DuckDB SQL for the registered query."""
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{n}' THEN {v}" for n, v in sorted(mix.weights.get(level, {}).items()))
        default = mix.default.get(level, 1)
        return f"CASE {level} {cases} ELSE {default} END" if cases else str(default)

    parts, keys = [], []
    for level in LEVELS:
        above = f"g_{keys[-1]}" if keys else None
        part = f"PARTITION BY {', '.join(keys)} " if keys else ""
        by = ", ".join([*keys, level])
        given = (f"(SELECT given FROM {above} a WHERE " + " AND ".join(f"a.{k} = n.{k}" for k in keys) + ")" if keys else
                 f"least(CAST(floor((SELECT sum(tokens) FROM leaf) * {float(mix.budget_share)!r}) AS BIGINT), sum(cap) OVER ())")
        parts.append(f"""n_{level} AS (SELECT {by}, CAST(sum(cap) AS BIGINT) AS cap, any_value(w_{level}) AS w FROM live GROUP BY {by}),
b_{level} AS (SELECT n.*, CAST({given} AS BIGINT) AS given FROM n_{level} n),
l_{level} AS (SELECT *, CAST(given - coalesce(sum(cap) OVER ({part}ORDER BY CAST(cap AS DOUBLE) / w, {level}
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / CAST(sum(w) OVER ({part}ORDER BY CAST(cap AS DOUBLE) / w, {level}
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS l FROM b_{level}),
g_{level} AS (SELECT {by}, least(cap, greatest(0, CAST(floor(w * max(l) OVER ({part})) AS BIGINT))) AS given FROM l_{level})""")
        keys.append(level)
    same = " AND ".join(f"p.{k} = d.{k}" for k in LEVELS)
    key = ", ".join(LEVELS)
    names = ", ".join(f"'{d}'" for d in DOMAINS)
    return f"""WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
    [{names}][coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT), 0) % {len(DOMAINS)} + 1] AS domain,
    coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source FROM documents),
leaf AS (SELECT {key}, sum(n_tokens) AS tokens FROM d GROUP BY {key}),
live AS (SELECT *, tokens * {mix.max_epochs} AS cap, {', '.join(f'{weight(x)} AS w_{x}' for x in LEVELS)} FROM leaf),
{', '.join(parts)},
p AS (SELECT leaf.*, g.given AS budget, CASE WHEN tokens > 0 THEN CAST(floor(CAST(g.given AS DOUBLE) / tokens) AS BIGINT) ELSE 0 END AS epochs
  FROM leaf JOIN g_{LEVELS[-1]} g USING ({key})),
o AS (SELECT d.*, p.epochs, p.budget - p.epochs * p.tokens AS rest, md5('{mix.seed}:' || p.epochs || ':' || d.doc_id) AS place
  FROM d JOIN p ON {same}),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {key} ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - n_tokens AS before FROM o),
u AS (SELECT *, epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS uses FROM r)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch
FROM (SELECT *, unnest(range(CAST(uses AS BIGINT))) AS epoch FROM u WHERE uses > 0)"""
