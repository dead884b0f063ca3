"""Joins, guards, top-1 lookups and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.functions import cleanse as c
from claimflow.functions.clock import stamp

# --- guards -----------------------------------------------------------------


def stored_keys(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys of ``df`` that are stored.

    A semi or anti join can only broadcast its right side, which must not be the large
    state. Reducing the state to the keys of the batch first lets Spark broadcast the
    batch keys, so a small batch never shuffles the state.
    """
    return _stored_rows(df, state, keys).distinct()


def _stored_rows(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """``stored_keys`` as often as they are stored: a semi or anti join needs no more, so neither side keeps a table of its keys."""
    return state.select(*keys).join(df.select(*keys), keys, "left_semi")


def exists_in(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is stored."""
    return df.join(_stored_rows(df, state, keys), keys, "left_semi")


def missing_in(df: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored."""
    return df.join(_stored_rows(df, state, keys), keys, "left_anti")


new_records = missing_in
known_records = exists_in


def missing_from(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Set difference: stored keys the batch no longer shows."""
    return state.join(batch.select(*keys).distinct(), keys, "left_anti")


# --- lookups ----------------------------------------------------------------


def lookup(df: DataFrame, pairs: DataFrame, key: Column, default: Column, name: str) -> DataFrame:
    """Add ``name``: the value of a (code, value) table with one row per code, else ``default``.

    Spark broadcasts the table if it is small enough.
    """
    code, value = pairs.columns
    side = pairs.select(F.col(code).alias("_code"), F.col(value).alias("_value"))
    return (
        df.withColumn("_key", key)
        .join(side, F.col("_key") == F.col("_code"), "left")
        .withColumn(name, F.coalesce(F.col("_value"), default))
        .drop("_key", "_code", "_value")
    )


def resolve_uf(df: DataFrame, area_map: DataFrame, area: str = "ddd", state: str = "uf_text", name: str = "uf") -> DataFrame:
    """State by area code, else the first two letters of the state text (SP if missing)."""
    text = F.coalesce(c.nullify(F.col(state), c.BLANK_STATE), F.lit("SP"))
    own = F.upper(c.clamp(c.strip(text), 2))
    return lookup(df, area_map, c.area_number(F.col(area)), own, name)


def repair_uf(df: DataFrame, area_map: DataFrame, area: str = "ddd", state: str = "uf_text", name: str = "uf") -> DataFrame:
    """As ``resolve_uf``, but the state text is kept at full length."""
    own = F.coalesce(c.nullify(F.upper(c.strip(F.col(state))), c.BLANK_STATE), F.lit("SP"))
    return lookup(df, area_map, c.area_number(F.col(area)), own, name)


def with_labels(df: DataFrame, *joins: tuple[DataFrame, str, str, dict[str, str]]) -> DataFrame:
    """Left-join dictionaries: (dictionary, its key, our key, {output: dictionary column})."""
    for number, (dictionary, code, ours, columns) in enumerate(joins):
        side = dictionary.select(
            F.col(code).alias(f"_code{number}"), *[F.col(source).alias(out) for out, source in columns.items()]
        )
        df = df.join(side, F.col(ours) == F.col(f"_code{number}"), "left").drop(f"_code{number}")
    return df


def party_of_type(party: DataFrame, *types: int) -> DataFrame:
    return party.filter(F.col("type").isin(*types))


def valid_contact(contacts: DataFrame) -> DataFrame:
    """E-mails must contain '@', other contacts must have a value."""
    return contacts.filter(
        F.when(F.col("type") == 3, F.col("value").contains("@")).otherwise(F.col("value").isNotNull())
    )


# --- top 1 per group --------------------------------------------------------


def top1(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. ``row_number() = 1`` lets Spark keep one row per key and map task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the smallest ``order`` per key; a hash of the other columns breaks ties.

    Spark keeps one row per key and map task before the shuffle.
    """
    return top1(df, [key], _total(df, key, F.col(order).asc_nulls_last()))


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the largest ``order`` per key; ties as in ``first_per_key``."""
    return top1(df, [key], _total(df, key, F.col(order).desc_nulls_last()))


def _total(df: DataFrame, key: str, order: Column) -> list[Column]:
    return [order, F.xxhash64(*[name for name in df.columns if name != key])]


def party_key(party: DataFrame) -> DataFrame:
    """(process, type, party): the party of a role; the highest id counts where a process has several."""
    return party.groupBy("process", "type").agg(F.max("id").alias("party"))


def first_row(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def best_contact(
    contact: DataFrame, kinds: dict[str, int], party: str | tuple[str, ...] = "party", tie: tuple[str, ...] = ("id",),
) -> DataFrame:
    """Best contact per party (one column or several) and kind.

    Principal contacts first, unknown ones last. Spark keeps one row per party and map task before the
    shuffle, however many contacts a party has, with the kinds side by side: they are shuffled once.
    """
    keys = [party] if isinstance(party, str) else list(party)
    rank = F.coalesce(-F.col("principal"), F.lit(1))
    rest = [name for name in ("value", "area") if name not in tie]
    one = F.struct(rank.alias("_rank"), *[F.col(name) for name in (*tie, *rest)])
    best = contact.filter(F.col("type").isin(*kinds.values())).groupBy(*keys).agg(
        *[F.min(F.when(F.col("type") == code, one)).alias(name) for name, code in kinds.items()])
    return best.select(*keys, *[F.col(f"{name}.{field}").alias(f"{name}_{field}") for name in kinds for field in ("area", "value")])


# --- aggregates -------------------------------------------------------------


def min_event(events: DataFrame, floor, key: str = "process", at: str = "happened_at") -> DataFrame:
    return since(events, floor, at).groupBy(key).agg(F.min(at).alias("first_event"))


def since(events: DataFrame, floor, at: str = "happened_at") -> DataFrame:
    return events.filter(F.col(at) >= stamp(floor))


def current_user(history: DataFrame) -> DataFrame:
    """Highest user id and latest exit per process."""
    return history.groupBy("process").agg(F.max("user_id").alias("user_id"), F.max("left_at").alias("left_at"))


def last_change(process: DataFrame, event: DataFrame, step: DataFrame) -> DataFrame:
    """Latest load time of a process, its events and its steps. Each table is aggregated where it lies: tables bucketed by process stay in place."""
    rows = process.select("id", F.col("loaded_at").alias("_own"))
    for number, facts in enumerate((event, step)):
        newest = facts.groupBy(F.col("process").alias("id")).agg(F.max("loaded_at").alias(f"_newest{number}"))
        rows = rows.join(newest, "id", "left")
    return rows.select("id", F.greatest("_own", "_newest0", "_newest1").alias("last_change"))


def union_dates(*sources: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def batch_metrics(batch: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Read, new and known records of a batch in one row."""
    marked = batch.select(key).join(known_ids_marked(known, batch, key), key, "left")
    stored = F.col("_known").isNotNull()
    return marked.agg(
        F.count(F.lit(1)).alias("read"), F.count_if(~stored).alias("new"), F.count_if(stored).alias("known")
    )


def known_ids_marked(known: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    wanted = batch.select(key).distinct()
    return known.select(key).join(wanted, key, "left_semi").distinct().withColumn("_known", F.lit(1))


def batch_users(batch: DataFrame) -> DataFrame:
    return batch.select("user_id").dropna().distinct()


def changed_count(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """How many keyed rows an update changed."""
    old = before.select(key, F.struct(*columns).alias("_old"))
    new = after.select(key, F.struct(*columns).alias("_new"))
    return old.join(new, key).agg(F.count_if(~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"))


# --- satellites of a base table ---------------------------------------------


def with_every_key(satellite: DataFrame, keys: DataFrame, key: str, present: DataFrame | None = None) -> DataFrame:
    """The satellite's rows of the given keys, and a row of NULLs for each key without any.

    Joined inner, this is a left join whose satellite may be split at a hot key: of a plain left
    join Spark can only split the left side. ``keys`` is unique. Where ``present`` (key) lists the satellite's keys more
    cheaply than its rows do, it does so, and rows of other keys are left for the inner join to drop.
    """
    held = satellite.join(keys, key, "left_semi") if present is None else satellite
    bare = keys.join(satellite.select(key) if present is None else present, key, "left_anti")
    return held.unionByName(bare, allowMissingColumns=True)
