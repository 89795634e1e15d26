"""Balanced samples, sets of identities, quotas, attempt rates and gates of an evaluation run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENVIRONMENT = ("dns_failure", "environment")


def quotas(target: int, scopes: tuple[str, str], first: int | None = None) -> list[str]:
    """Scopes in the order they are to be filled: in turn until one has its share, then the other; the first share is the larger half."""
    first = -(-target // 2) if first is None else min(first, target)
    left, out = {scopes[0]: first, scopes[1]: target - first}, []
    while len(out) < target:
        for s in scopes:
            if left[s]:
                out.append(s)
                left[s] -= 1
    return out


def usage_rates(attempts: DataFrame, by: str) -> DataFrame:
    """Good and bad attempts by ``by`` and the damped rate bad / (good + bad + 2); environment failures count nowhere."""
    x = attempts.where(~F.col("result").isin(*ENVIRONMENT))
    bad = F.count_if(F.col("result").isin("failed", "scope_hint_mismatch"))
    good = F.count_if(~F.col("result").isin("failed", "scope_hint_mismatch"))
    return x.groupBy(by).agg(good.alias("good"), bad.alias("bad"), (bad / (good + bad + 2)).alias("rate"))


def next_candidate(candidates: DataFrame, attempts: DataFrame, scope: str) -> DataFrame:
    """The one candidate to try next for a scope, or none.

    Left out: other scopes, URLs already attempted, identities already
    captured.  Order: scope-mismatch rate and unavailability rate of the URL
    family, use of the type, bucket and decade plus half their failures, then
    the hash of the URL.
    """
    tried = attempts.select("url").distinct()
    captured = attempts.where("result in ('complete', 'reused_capture', 'existing_capture')").select("document_id").distinct()
    x = candidates.where(F.col("scope") == scope).join(tried, "url", "left_anti").join(captured, "document_id", "left_anti")
    real = attempts.where(~F.col("result").isin(*ENVIRONMENT))
    part = lambda what: real.groupBy("family").agg((F.count_if(F.col("result") == what) / (F.count(F.lit(1)) + 2)).alias(f"_{what}"))
    x = x.join(part("scope_hint_mismatch"), "family", "left").join(part("failed"), "family", "left")
    for c in ("type", "bucket", "decade"):
        use = real.groupBy(F.col(c).alias("_k")).agg((F.count_if(F.col("result") != "failed") + F.count_if(F.col("result") == "failed") / 2).alias(f"_{c}"))
        x = x.join(use, F.col(c).eqNullSafe(F.col("_k")), "left").drop("_k")
    keys = [F.coalesce(c, F.lit(0.0)) for c in ("_scope_hint_mismatch", "_failed", "_type", "_bucket", "_decade")]
    return x.orderBy(*keys, F.sha2("url", 256), "url").limit(1).select(*candidates.columns)


def target_manifest(available: DataFrame, required: list[str], size: int, keys: tuple[str, ...] = ("scope", "type", "decade")) -> tuple[list[str], int]:
    """(ids, deficit): required ids first, then the greedy fill by least used scope, type and decade, URL hash and id.

    Required ids that are not available are an error.  The step is sequential,
    so the driver holds, for each combination of keys, the first ``size``
    candidates by hash: no more than ``size`` times the combinations.
    """
    ids = available.where(F.col("document_id").isin(required)).select("document_id", *keys).distinct().collect() if required else []
    missing = sorted(set(required) - {r["document_id"] for r in ids})
    if missing:
        raise ValueError(f"not available: {', '.join(missing)}")
    own = {r["document_id"]: tuple(r[k] for k in keys) for r in ids}
    chosen = list(dict.fromkeys(required))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h", "document_id"))
    rest = available.where(~F.col("document_id").isin(required)) if required else available
    few = rest.select("document_id", *keys, F.sha2("url", 256).alias("_h")).withColumn("_r", rank).where(F.col("_r") <= size).collect()
    queues: dict[tuple, list] = {}
    for r in sorted(few, key=lambda r: (r["_h"], r["document_id"])):
        queues.setdefault(tuple(r[k] for k in keys), []).append((r["_h"], r["document_id"]))
    used: list[dict] = [{} for _ in keys]
    for i in chosen:
        for u, v in zip(used, own[i], strict=True):
            u[v] = u.get(v, 0) + 1
    while len(chosen) < size and queues:
        best = min(queues, key=lambda g: (*[u.get(v, 0) for u, v in zip(used, g, strict=True)], queues[g][0]))
        chosen.append(queues[best].pop(0)[1])
        if not queues[best]:
            del queues[best]
        for u, v in zip(used, best, strict=True):
            u[v] = u.get(v, 0) + 1
    return chosen[:size] if len(required) <= size else chosen, max(0, size - len(chosen))


def set_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: sizes of both sets of keys, of either difference, whether they are equal, contained, disjoint."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(1)), right.select(key).distinct().withColumn("_b", F.lit(1))
    n = a.join(b, key, "full_outer").agg(
        F.count("_a").alias("n_left"), F.count("_b").alias("n_right"), F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"))
    return n.withColumns({"equal": F.expr("only_left + only_right = 0"), "left_in_right": F.expr("only_left = 0"), "disjoint": F.expr("n_left = only_left")})


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, as when manifests are united."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def pending(captured: list[str], target: list[str]) -> list[str]:
    """Captured ids that are not in the target, as first seen."""
    done = set(target)
    return [x for x in dict.fromkeys(captured) if x not in done]


def attempt_summary(attempts: DataFrame) -> DataFrame:
    """One row: attempts by result, network and reuse counts, acceptance rates (null without attempts)."""
    results = ("complete", "failed", "scope_hint_mismatch", "reused_capture", "existing_capture", "interrupted", "duplicate")
    n = [F.count_if(F.col("result") == r).alias(r) for r in results]
    x = attempts.agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("result").isin(*ENVIRONMENT)).alias("environment"), *n)
    source = F.col("attempts") - F.col("environment")
    return x.withColumns({"acceptance_rate": F.round(F.try_divide("complete", "attempts"), 4), "source_acceptance_rate": F.round(F.try_divide(F.col("complete"), source), 4)})


def converged(waves: DataFrame, order: str = "wave", classes: str = "new_classes") -> DataFrame:
    """Waves with ``converged``: this and the last wave have at most two new bug classes, and not more than before.  One row a wave."""
    w = Window.orderBy(order)
    return waves.withColumn("converged", F.coalesce((F.max(classes).over(w.rowsBetween(-1, 0)) <= 2) & (F.col(classes) <= F.lag(classes).over(w)), F.lit(False)))


def failing_gates(records: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """Records with ``failing``, the names of the gates that do not hold, in the order given; unknown is failing."""
    return records.withColumn("failing", F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in gates.items()])))


def compare_sizes(before: DataFrame, after: DataFrame, key: str, size: str) -> DataFrame:
    """One row: documents, bytes before and after, reduction in percent; a document that one side lacks is an error."""
    a, b = before.select(key, F.col(size).alias("_a")), after.select(key, F.col(size).alias("_b"))
    x = a.withColumn("_l", F.lit(1)).join(b.withColumn("_r", F.lit(1)), key, "full_outer")
    lost = F.count_if(F.col("_l").isNull() | F.col("_r").isNull())
    n = x.agg(F.count(F.lit(1)).alias("documents"), F.sum("_a").alias("bytes_before"), F.sum("_b").alias("bytes_after"), lost.alias("_lost"))
    n = n.where(F.when(F.col("_lost") > 0, F.raise_error(F.lit("documents on one side only"))).otherwise(True).cast("boolean"))
    return n.withColumn("reduction_percent", F.round(F.try_divide((F.col("bytes_before") - F.col("bytes_after")) * 100.0, F.col("bytes_before")), 2)).drop("_lost")
