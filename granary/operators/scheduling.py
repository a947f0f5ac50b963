"""Incremental planning. The graph is control plane; the corpus plan is a table, so it scales with conversations."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checks, identity

#: Global stages and what they depend on.
GLOBAL = {"K04": ["K03"], "K05": ["K02", "K04"], "K06": ["K05"], "K07": ["K05"], "K08": ["K06", "K07"], "K09": ["K04", "K05", "K06", "K07", "K08"], "K10": ["K04", "K05", "K06", "K07", "K08", "K09"], "K11": ["K02", "K05", "K06", "K07", "K08", "K10"]}
LOCAL = ["K01", "K02", "K03"]


class GraphError(ValueError):
    """Duplicate or unknown task, self-dependency or cycle."""


@dataclass(frozen=True)
class Spec:
    stage: str
    partition: str
    version: str = "0.1.0"
    contract: str = ""
    config_hash: str = hashlib.sha256(b"{}").hexdigest()
    input_hash: str = ""
    dependencies: tuple[tuple[str, str], ...] = ()

    @property
    def key(self) -> tuple[str, str]:
        return (self.stage, self.partition)


def fingerprint(spec: Spec, outputs: dict) -> str:
    if missing := [d for d in spec.dependencies if d not in outputs]:
        raise GraphError(f"missing outputs: {missing}")
    return hashlib.sha256(identity.canonical_json([*spec.key, spec.version, spec.contract, spec.config_hash, spec.input_hash, sorted([*d, outputs[d]] for d in spec.dependencies)]).encode()).hexdigest()


def levels(specs: list[Spec]) -> dict:
    """Longest path from a source; the waves of a build."""
    tasks = {s.key: s for s in specs}
    if len(tasks) != len(specs):
        raise GraphError("duplicate task")
    waiting, users, level = {}, {}, {}
    for s in specs:
        if s.key in s.dependencies:
            raise GraphError(f"{s.key} depends on itself")
        if unknown := [d for d in s.dependencies if d not in tasks]:
            raise GraphError(f"unknown dependency: {unknown[0]}")
        waiting[s.key] = len(set(s.dependencies))
        for d in set(s.dependencies):
            users.setdefault(d, []).append(s.key)
    ready = [k for k, n in waiting.items() if n == 0]
    level = dict.fromkeys(ready, 0)
    while ready:
        k = ready.pop()
        for u in users.get(k, ()):
            level[u] = max(level.get(u, 0), level[k] + 1)
            waiting[u] -= 1
            if waiting[u] == 0:
                ready.append(u)
    if any(waiting.values()):
        raise GraphError("cycle")
    return level


def complete(spec: Spec, outputs: dict, output_hash: str) -> dict:
    return {"fingerprint": fingerprint(spec, outputs), "output_hash": output_hash, "status": "complete"}


def failed(spec: Spec, outputs: dict) -> dict:
    return {"fingerprint": fingerprint(spec, outputs), "output_hash": None, "status": "failed"}


def plan(specs: list[Spec], cache: dict) -> list[dict]:
    """stage, partition, wave, disposition, reason in order of wave and key. cache: key -> entry. Plan again after each wave: an
    unchanged output turns what follows back to reuse."""
    level, outputs, run, out = levels(specs), {}, set(), []
    for s in sorted(specs, key=lambda s: (level[s.key], s.key)):
        entry = cache.get(s.key)
        if any(d in run for d in s.dependencies):
            reason = "dependency_dirty"
        elif any(d not in outputs for d in s.dependencies):
            reason = "dependency_cache_unavailable"
        elif entry is None:
            reason = "no_cache"
        elif entry["status"] == "failed":
            reason = "previous_failure"
        elif entry["fingerprint"] != fingerprint(s, outputs):
            reason = "fingerprint_changed"
        else:
            reason, outputs[s.key] = "exact_cache_hit", entry["output_hash"]
        if reason != "exact_cache_hit":
            run.add(s.key)
        out.append({"stage": s.stage, "partition": s.partition, "wave": level[s.key], "disposition": "reuse" if reason == "exact_cache_hit" else "run", "reason": reason})
    return out


def waves(planned: list[dict]) -> list[list[tuple[str, str]]]:
    """Tasks to run, by wave; empty waves are left out."""
    by: dict[int, list] = {}
    for p in planned:
        if p["disposition"] == "run":
            by.setdefault(p["wave"], []).append((p["stage"], p["partition"]))
    return [by[k] for k in sorted(by)]


def corpus(hashes: dict[str, str], global_hash: str) -> list[Spec]:
    """Conversation-local K01 to K03, then K04 to K11 over everything."""
    if len(global_hash) != 64:
        raise ValueError("the global input hash is a SHA-256")
    specs = [Spec(st, c, contract=f"{st}.v0", input_hash=h, dependencies=((LOCAL[i - 1], c),) if i else ()) for c, h in sorted(hashes.items()) for i, st in enumerate(LOCAL)]
    for st, needs in GLOBAL.items():
        deps = tuple((n, c) for n in needs for c in (sorted(hashes) if n in LOCAL else ["global"]))
        specs.append(Spec(st, "global", contract=f"{st}.v0", input_hash=global_hash, dependencies=deps))
    return specs


def scale_probe(n: int) -> dict[str, int]:
    """Tasks, waves, and what runs again after one conversation changes."""
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    before = corpus({f"c{i:06d}": h(f"a{i}") for i in range(n)}, h("global"))
    outputs, cache = {}, {}
    level = levels(before)
    for s in sorted(before, key=lambda s: level[s.key]):
        cache[s.key] = complete(s, outputs, h(str(s.key)))
        outputs[s.key] = h(str(s.key))
    after = corpus({f"c{i:06d}": h(f"a{i}" if i else "changed") for i in range(n)}, h("global"))
    again = [p for p in plan(after, cache) if p["disposition"] == "run"]
    return {"tasks": len(before), "map_tasks": 3 * n, "global_tasks": len(GLOBAL), "waves": len(waves(plan(before, {}))), "run_after_change": len(again), "reused_after_change": len(after) - len(again)}


def corpus_plan(current: DataFrame, cached: DataFrame) -> DataFrame:
    """stage, partition, wave, disposition, reason of the corpus graph from conversation hashes (partition, input_hash) now and
    as cached (with status): a table, however many conversations there are."""
    checks.unique(current, "partition", what="conversations")
    x = current.join(cached.select("partition", F.col("input_hash").alias("old"), "status"), "partition", "left")
    first = F.when(F.col("old").isNull(), "no_cache").when(F.col("status") == "failed", "previous_failure").when(F.col("old") != F.col("input_hash"), "fingerprint_changed").otherwise("exact_cache_hit")
    local = F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(i).alias("wave")) for i, s in enumerate(LOCAL))))
    x = x.withColumn("first", first)
    y = x.select("partition", "first", local.alias("s")).select("s.stage", "partition", "s.wave", F.when((F.col("s.wave") > 0) & (F.col("first") != "exact_cache_hit"), "dependency_dirty").otherwise(F.col("first")).alias("reason"))
    depth = {}
    for st, needs in GLOBAL.items():
        depth[st] = 1 + max(LOCAL.index(n) if n in LOCAL else depth[n] for n in needs)
    dirty = x.agg(F.coalesce(F.bool_or(F.col("first") != "exact_cache_hit"), F.lit(False)).alias("dirty"))
    whole = F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(d).alias("wave")) for s, d in depth.items())))
    g = dirty.select("dirty", whole.alias("s")).select("s.stage", F.lit("global").alias("partition"), "s.wave", F.when(F.col("dirty"), "dependency_dirty").otherwise("exact_cache_hit").alias("reason"))
    return y.unionByName(g).withColumn("disposition", F.when(F.col("reason") == "exact_cache_hit", "reuse").otherwise("run"))


def plan_table(current: DataFrame, cached: DataFrame, global_hash: str, config: dict[str, str] | None = None, version: str = "0.1.0") -> DataFrame:
    """stage, partition, wave, disposition, reason, fingerprint of the corpus graph by fingerprints, as a table. current: partition,
    input_hash; cached: stage, partition, fingerprint, output_hash, status. A local task's fingerprint takes the cached output of the
    stage before; a global one's the cached outputs of all that it depends on, those of a local stage by one digest. It is null
    where a dependency will run or has no output."""
    checks.unique(current, "partition", what="conversations")
    checks.unique(cached, "stage", "partition", what="cached tasks")
    config, none = config or {}, Spec.config_hash

    def task(x: DataFrame, st: str, wave: int, input_hash) -> DataFrame:
        """x: partition, dirty, lost (a dependency runs; lacks an output), outputs (array)."""
        own = cached.where(F.col("stage") == st).select("partition", F.col("fingerprint").alias("old"), "output_hash", "status")
        print_ = identity.key_id(F.lit(st), "partition", F.lit(version), F.lit(f"{st}.v0"), F.lit(config.get(st, none)), input_hash, F.array_join(F.array_sort("outputs"), ","))
        y = x.withColumn("fingerprint", F.when(~F.col("dirty") & ~F.col("lost"), print_)).join(own, "partition", "left")
        reason = F.when(F.col("dirty"), "dependency_dirty").when(F.col("lost"), "dependency_cache_unavailable").when(F.col("status").isNull(), "no_cache").when(F.col("status") == "failed", "previous_failure").when(F.col("old") != F.col("fingerprint"), "fingerprint_changed").otherwise("exact_cache_hit")
        return y.select(F.lit(st).alias("stage"), "partition", F.lit(wave).alias("wave"), reason.alias("reason"), "fingerprint", "output_hash")

    done: dict[str, DataFrame] = {}
    nothing = F.array().cast("array<string>")
    x = current.select("partition", "input_hash", F.lit(False).alias("dirty"), F.lit(False).alias("lost"), nothing.alias("outputs"))
    for i, st in enumerate(LOCAL):
        done[st] = task(x, st, i, F.col("input_hash"))
        runs = F.col("reason") != "exact_cache_hit"
        x = done[st].join(current.select("partition", "input_hash"), "partition").select("partition", "input_hash", runs.alias("dirty"), (~runs & F.col("output_hash").isNull()).alias("lost"), F.array_compact(F.array("output_hash")).alias("outputs"))
    # the global tasks are eight rows: planned on the driver from a summary of each local stage
    facts: dict[str, tuple[bool, bool, str]] = {}  # stage -> it runs, it lacks an output, digest of its outputs
    for st in {n for needs in GLOBAL.values() for n in needs if n in LOCAL}:
        ran = F.col("reason") != "exact_cache_hit"
        some = done[st].agg(F.coalesce(F.bool_or(ran), F.lit(False)), F.coalesce(F.bool_or(~ran & F.col("output_hash").isNull()), F.lit(False))).first()
        facts[st] = (some[0], some[1], "" if some[0] else identity.table_hash(done[st].select("partition", "output_hash")).first()[0] or "")
    old = {r["stage"]: r for r in cached.where("partition = 'global'").collect()}
    depth, rows = {}, []
    for st, needs in GLOBAL.items():
        depth[st] = 1 + max(LOCAL.index(n) if n in LOCAL else depth[n] for n in needs)
        entry, print_ = old.get(st), None
        if any(facts[n][0] for n in needs):
            reason = "dependency_dirty"
        elif any(facts[n][1] for n in needs):
            reason = "dependency_cache_unavailable"
        else:
            outputs = ",".join(sorted(f"{n}:{facts[n][2]}" for n in needs))
            print_ = hashlib.sha256("|".join([st, "global", version, f"{st}.v0", config.get(st, none), global_hash, outputs]).encode()).hexdigest()
            reason = "no_cache" if entry is None else "previous_failure" if entry["status"] == "failed" else "fingerprint_changed" if entry["fingerprint"] != print_ else "exact_cache_hit"
        hit = reason == "exact_cache_hit"
        facts[st] = (not hit, hit and entry["output_hash"] is None, (entry["output_hash"] or "") if hit else "")
        rows.append((st, "global", depth[st], reason, print_))
    out = current.sparkSession.createDataFrame(rows, "stage string, partition string, wave int, reason string, fingerprint string")
    for t in done.values():
        out = out.unionByName(t.drop("output_hash"))
    return out.withColumn("disposition", F.when(F.col("reason") == "exact_cache_hit", "reuse").otherwise("run"))


def fingerprints(tasks: DataFrame) -> DataFrame:
    """Adds fingerprint to stage, partition, version, contract, config_hash, input_hash, dependencies (outputs, array)."""
    return tasks.withColumn("fingerprint", identity.key_id("stage", "partition", "version", "contract", "config_hash", "input_hash", F.array_join(F.array_sort("dependencies"), ",")))
