"""The three workloads, composed of the operators: curate, plan, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.config import Config
from chatloom.operators import planning as P
from chatloom.operators import reporting as R
from chatloom.operators.dedup import dup_reason, keyed
from chatloom.operators.parsing import clean_llm_text, parse_json_pairs, to_chatml
from chatloom.operators.validation import process
from chatloom.sources.conversations import routed
from chatloom.sources.scratch import stored


def curate(raw: DataFrame, cfg: Config, system_prompt: str, day: str) -> DataFrame:
    """(conv_id, ok, reason, dup_reason, bucket, tag, record) of raw(conv_id, seq, text). Dedup sees repaired text; rejects enter no memory."""
    text = parse_json_pairs(clean_llm_text(F.coalesce("text", F.lit(""))), cfg.persona)
    # Written once: the marks below read the rows from many sides.
    done = stored(process(raw.select("conv_id", text.alias("text")), cfg).join(raw.select("conv_id", "seq"), "conv_id"), "validated")
    marks = dup_reason(keyed(done.where("ok")), cfg.signature_threshold, cfg.opening_threshold).select("conv_id", "dup_reason")
    out = routed(done.join(marks, "conv_id", "left"), day)
    kept = F.col("dup_reason") == "unique"
    return out.select(
        "conv_id", "ok", "reason", "dup_reason",
        *(F.when(kept, F.col(c)).alias(c) for c in ("bucket", "tag")),
        F.when(kept, to_chatml(F.col("turns"), system_prompt)).alias("record"),
    )


def plan(topics: DataFrame, total: int, stages: list[tuple[str, float]], tones: list[tuple[str, float]], styles: list[tuple[str, float]],
         edges: list[tuple[str, float, int]], seed: int = 42) -> DataFrame:
    """A row per slot: leaf, slot, stage, tone, style and edge."""
    leaves = P.flatten_tree(topics)
    quotas = P.allocate_quotas(leaves, total).withColumn("generated", F.lit(0).cast("long"))
    slots = P.expand_plan(P.seeded_order(leaves, seed).select("leaf_path", "pos").join(quotas, "leaf_path"))
    slots = slots.withColumn("slot_id", F.concat_ws("#", "leaf_path", "slot"))
    out = P.weighted_pick(slots, stages, "stage", seed).withColumn("stage", F.col("stage").cast("int"))
    out = P.weighted_pick(P.weighted_pick(out, tones, "tone", seed), styles, "style", seed)
    return P.edge_pick(out, edges, seed)


def report(log: DataFrame, state: DataFrame, states_of_keys: DataFrame, as_of: str, target: int) -> DataFrame:
    """One row: progress, leaf completion and the number of keys in each state. All three inputs are single rows or a few."""
    keys = states_of_keys.agg(*(F.count_if(F.col("state") == s).alias(f"keys_{s}") for s in ("working", "dead", "cooling", "unknown")))
    on = F.lit(True)
    return R.progress_report(log, as_of, target).join(R.leaf_completion(state), on).join(keys, on)
