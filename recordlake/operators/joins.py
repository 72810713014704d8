"""Key joins of the record flows (J1-J6) and the null-safe ``skip_seen``.

Null-key semantics differ per operator and are kept on purpose:

* anti joins (``new_rows``, ``append_first_wins``) keep null-key rows: null never matches;
* the inner join (``enrich_inner``) drops null codes;
* ``attach_results`` and ``skip_seen`` match null with null (like a pandas merge / isin).

All joins are equi-joins without hints, one plan for every size. The batch-vs-history anti joins (J1, P6)
read the history's key column alone and shuffle it once; both sides come straight from their
shuffles, so AQE can split the partitions that null or hot keys make too large (see ``skew``) and
turn a join whose history is small into a broadcast one. J5 reduces the batch to one row per key
before it meets the history, so no key is hot there, and J4 cuts the results to the batch's keys
before it reduces them. Catalyst and AQE broadcast a side where its bytes are under
``spark.sql.autoBroadcastJoinThreshold``, never by a number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.operators.skew import any_null, null_safe_cond


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def stored_keys(stored: DataFrame, keys) -> DataFrame:
    """Complete keys of a stored table: the build side of an anti or semi join.

    Not deduplicated: duplicates cannot change an anti/semi join, and a build side read
    straight from its shuffle lets AQE split oversized (skewed) partitions of the row
    side; a ``distinct`` here would put an aggregate between shuffle and join.
    """
    ks = _keys(keys)
    return stored.select(*ks).where(~any_null(ks))


def new_rows(batch: DataFrame, stored: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet (J1). Null-key rows always stay."""
    ks = _keys(keys)
    return batch.join(stored_keys(stored, ks), ks, "left_anti")


def unmatched_codes(df: DataFrame, registry: DataFrame, code: str,
                    registry_code: str | None = None) -> DataFrame:
    """Distinct codes of ``df`` missing from the registry (J2); a null code is reported once."""
    from recordlake.operators.aggs import distinct_codes

    rc = registry_code or code
    reg = registry.select(F.col(rc).alias(code)).where(F.col(code).isNotNull())
    return distinct_codes(df, code).join(reg, code, "left_anti")


def enrich_inner(df: DataFrame, registry: DataFrame, code: str,
                 dedupe_registry: bool = False, unique: bool = False) -> DataFrame:
    """Inner equi-join with the registry (J3): unresolved rows and null codes are left out.

    The registry is expected to hold one entry per code; the flows keep it so (deduped when
    created, resolved codes appended only when missing). That keeps the build side a plain
    shuffle, which AQE can split under a hot code. A caller whose registry may repeat a
    code passes ``dedupe_registry=True`` to reduce it to one entry per code (the greatest row)
    first, so rows are never multiplied. One who wants to hear of it passes ``unique=True``: the run then
    fails on a code listed twice, found in the same pass by a count next to the join's own shuffle. Either way a hot code's
    partition is no longer split, as an aggregate stands between shuffle and join.
    """
    if unique:
        registry = unique_by_key(registry, code)
    return df.join(dedupe_by_key(registry, code) if dedupe_registry else registry, code, "inner")


def unique_by_key(rows: DataFrame, keys) -> DataFrame:
    """``rows`` without those of a null key, as they are; the run fails if a key is listed twice."""
    ks = _keys(keys)
    others = [c for c in rows.columns if c not in ks]
    per_key = rows.where(~any_null(ks)).groupBy(*ks).agg(
        F.count(F.lit(1)).alias("_rl_n"), *([F.any_value(F.struct(*others)).alias("_rl_row")] if others else []))
    twice = F.raise_error(F.concat(F.lit("listed more than once: "), F.to_json(F.struct(*ks))))
    one = per_key.where(F.when(F.col("_rl_n") > 1, twice).otherwise(F.lit(True)))
    return one.select(*[F.col(k) if k in ks else F.col(f"_rl_row.{k}").alias(k) for k in rows.columns])


def dedupe_by_key(results: DataFrame, keys) -> DataFrame:
    """One row per key (null is one key): the greatest row, compared column by column, nulls lowest."""
    ks = _keys(keys)
    others = [c for c in results.columns if c not in ks]
    if not others:
        return results.distinct()
    best = results.groupBy(*ks).agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_rl_row"))
    return best.select(*[F.col(k) if k in ks else F.col(f"_rl_row.{k}").alias(k) for k in results.columns])


def attach_results(batch: DataFrame, results: DataFrame, keys) -> DataFrame:
    """Left join of look-up results onto a batch, null matching null.

    Results are first reduced to one row per key (a row that some look-up produced), so a key
    listed twice in the batch gets its value once per batch row (no pairwise fan-out). Only the
    results of the batch's keys are reduced and joined.
    """
    ks = _keys(keys)
    wanted = batch.select(*ks).distinct().alias("_w")
    res = dedupe_by_key(results.alias("_a").join(wanted, null_safe_cond("_a", "_w", ks), "left_semi"), ks)
    value_cols = [c for c in res.columns if c not in ks]
    joined = batch.alias("_b").join(res.alias("_r"), null_safe_cond("_b", "_r", ks), "left")
    return joined.select(*[F.col(f"_b.{c}") for c in batch.columns],
                         *[F.col(f"_r.{c}") for c in value_cols])


def skip_seen(df: DataFrame, seen: DataFrame, keys) -> DataFrame:
    """Rows whose key is not in ``seen``, null matching null (P6, like ``~isin``)."""
    ks = _keys(keys)
    return (df.alias("_d").join(seen.select(*ks).alias("_s"), null_safe_cond("_d", "_s", ks), "left_anti")
            .select(*[F.col(f"_d.{c}") for c in df.columns]))


def append_first_wins(batch: DataFrame, stored: DataFrame | None, keys, file_col: str) -> DataFrame:
    """Rows to append when files are appended one by one in name order (J5), in one job.

    A row survives when its key is null, or its key is not stored and its file is the
    first file (by name) holding that key. Two rows of one key in that first file both
    survive, as with a file-by-file anti-join. Per-key work is a combinable ``min``
    (pre-aggregated map-side), checked against the stored keys, then one
    join on ``(key, file)`` brings the verdict back. Null-key rows are certain to survive and
    take no part in the joins.
    """
    from recordlake.operators.setops import first_file

    ks = _keys(keys)
    keyed = batch.where(~any_null(ks))
    firsts = first_file(keyed, ks, file_col)
    if stored is not None:
        # the history is cut to the batch's keys first: a small batch is broadcast to it
        seen = stored_keys(stored, ks).join(firsts.select(*ks), ks, "left_semi")
        firsts = firsts.join(seen, ks, "left_anti")
    kept = keyed.join(firsts, ks + [file_col], "left_semi").select(*batch.columns)
    return kept.unionByName(batch.where(any_null(ks)))


def resolve_and_grow_registry(pending: DataFrame, registry: DataFrame, lookups, code: str,
                              name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve codes against a registry, growing it from look-up results.

    ``pending`` rows carry ``code``; ``registry`` is ``(code, name)``. ``lookups`` gives
    look-up results ``(code, name, ...)``: either a frame, or a function that receives the
    frame of codes to look up (distinct, non-null, missing from the registry) and returns the
    results for them, so that expensive look-ups (page extraction) run for those codes only.
    One result per code is kept; a blank name counts as unresolved (P7).

    Returns ``(enriched, resolved, grown_registry)``: pending rows joined to the grown
    registry (unresolved rows left out), the newly resolved entries, and the registry
    with them appended.
    """
    from recordlake.operators.project import keep_resolved
    from recordlake.operators.setops import grow_registry

    missing = unmatched_codes(pending, registry, code).where(F.col(code).isNotNull())
    found = lookups(missing) if callable(lookups) else lookups
    per_code = dedupe_by_key(found.select(code, name).where(F.col(code).isNotNull()), code)
    per_code = per_code.join(missing, code, "left_semi")
    resolved = keep_resolved(per_code, name, [code, name])
    grown = grow_registry(registry.select(code, name), resolved)
    enriched = enrich_inner(pending, grown, code)
    return enriched, resolved, grown
