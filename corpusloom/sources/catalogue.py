"""Known sources and the blends made of them."""

from __future__ import annotations

import warnings
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.mixing import parse_weights

# Logical keys and the public names of the data sets they stand for.
PRETRAIN_SOURCES = {
    "cc_v2.1": "nvidia/Nemotron-CC-v2.1",
    "cc_v2": "nvidia/Nemotron-CC-v2",
    "code_v2": "nvidia/Nemotron-Pretraining-Code-v2",
    "code_v1": "nvidia/Nemotron-Pretraining-Code-v1",
    "cc_code_v1": "nvidia/Nemotron-CC-Code-v1",
    "math_v1": "nvidia/Nemotron-CC-Math-v1",
    "specialized_v1": "nvidia/Nemotron-Pretraining-Specialized-v1",
    "sft_v1": "nvidia/Nemotron-Pretraining-SFT-v1",
    "sample": "nvidia/Nemotron-Pretraining-Dataset-sample",
}
POSTTRAIN_SOURCES = {
    "instruction_chat": "nvidia/Nemotron-Instruction-Following-Chat-v1",
    "math_v2": "nvidia/Nemotron-Math-v2",
    "math_proofs": "nvidia/Nemotron-Math-Proofs-v1",
    "science": "nvidia/Nemotron-Science-v1",
    "agentic": "nvidia/Nemotron-Agentic-v1",
    "competitive_programming": "nvidia/Nemotron-Competitive-Programming-v1",
    "rl_blend": "nvidia/Nemotron-3-Nano-RL-Training-Blend",
}

# Default pre-training blend (key, weight) and the configuration of one of its sources.
PRETRAIN_BLEND = (("cc_v2.1", 0.5), ("code_v2", 0.2), ("math_v1", 0.15), ("specialized_v1", 0.1), ("cc_code_v1", 0.05))
SPECIALIZED_CONFIG = "Nemotron-Pretraining-Wiki-Rewrite"
SAMPLE_CONFIG = "Nemotron-CC-High-Quality"

# Fine-tuning blend (key, source key, weight, split, streamed), and the subsets that may be asked for.
SFT_BLEND = (
    ("chat", "instruction_chat", 0.3, "chat_if", True),
    ("math", "math_v2", 0.25, "train", True),
    ("math_proofs", "math_proofs", 0.15, "train", True),
    ("science", "science", 0.15, "train", True),
    ("agentic", "agentic", 0.1, "train", False),
    ("code", "competitive_programming", 0.05, "train", False),
)
SFT_SUBSETS = {"math": ("math", "math_proofs"), "code": ("code",), "science": ("science",), "chat": ("chat",)}

# Custom sources with rules of their own, and the source that stands in for a restricted one.
POST_TRAINING_V1 = "nvidia/Nemotron-Post-Training-Dataset-v1"
POST_TRAINING_V2 = "nvidia/Nemotron-Post-Training-Dataset-v2"
PART_OF_V1 = "Nemotron-Post-Training-Dataset-v1"
PART_OF_V2 = "Nemotron-Post-Training-Dataset-v2"
FALLBACKS = {POST_TRAINING_V2: POST_TRAINING_V1}


@dataclass(frozen=True)
class Source:
    """One source of a blend."""

    name: str
    weight: float = 1.0
    streaming: bool = True
    split: str | None = "train"
    config_name: str | None = None
    fallback_name: str | None = None


SOURCE_SCHEMA = (
    "name string, weight double, streaming boolean, split string, config_name string, fallback_name string"
)


def catalogue(spark: SparkSession) -> DataFrame:
    """All known sources: ``stage, key, name``."""
    rows = [("pretrain", k, n) for k, n in PRETRAIN_SOURCES.items()]
    rows += [("posttrain", k, n) for k, n in POSTTRAIN_SOURCES.items()]
    return spark.createDataFrame(rows, "stage string, key string, name string")


def blend_frame(spark: SparkSession, blend: list[Source]) -> DataFrame:
    return spark.createDataFrame([astuple(s) for s in blend], SOURCE_SCHEMA)


def pretrain_blend(
    name: str | None = None,
    config_name: str | None = None,
    use_sample: bool = False,
    weights: str | None = None,
    streaming: bool = True,
) -> list[Source]:
    """A named source alone; else the sample source alone; else the default blend with its weights overridden."""
    if name:
        return [Source(name, streaming=streaming, config_name=config_name)]
    if use_sample:
        return [Source(PRETRAIN_SOURCES["sample"], streaming=False, config_name=SAMPLE_CONFIG)]
    shares = parse_weights(weights, [w for _, w in PRETRAIN_BLEND])
    return [
        Source(
            PRETRAIN_SOURCES[key],
            weight=share,
            streaming=streaming,
            config_name=SPECIALIZED_CONFIG if key == "specialized_v1" else None,
        )
        for (key, _), share in zip(PRETRAIN_BLEND, shares, strict=True)
    ]


def sft_blend(name: str | None = None, subset: str | None = None, streaming: bool = True) -> list[Source]:
    """A named source with its split rules; else the sources of a subset; an unknown subset means all sources."""
    if name:
        return [_custom_sft(name, subset, streaming)]
    keys = [entry[0] for entry in SFT_BLEND]
    if subset is None or subset == "all":
        wanted = keys
    elif subset in SFT_SUBSETS:
        wanted = SFT_SUBSETS[subset]
    else:
        warnings.warn(f"unknown subset {subset}: using all sources", stacklevel=2)
        wanted = keys
    return [
        Source(POSTTRAIN_SOURCES[source], weight=weight, streaming=streaming and streamed, split=split)
        for key, source, weight, split, streamed in SFT_BLEND
        if key in wanted
    ]


def _custom_sft(name: str, subset: str | None, streaming: bool) -> Source:
    split, config = ("train_sft" if "ultrachat" in name else "train"), None
    restricted = PART_OF_V2 in name
    if restricted:
        config = "default"
    if subset and (restricted or PART_OF_V1 in name):
        split = subset
    fallback = FALLBACKS[POST_TRAINING_V2] if restricted else None
    return Source(name, streaming=streaming, split=split, config_name=config, fallback_name=fallback)
