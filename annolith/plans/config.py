"""Configurations as plain dictionaries: merges, differences, and what a difference asks of running workers."""

from __future__ import annotations

import inspect
from collections.abc import Callable

#: Engine settings that need a new engine, and the sampling defaults with their values.
RELOADING = (
    "model", "tensor_parallel_size", "max_model_len", "dtype", "gpu_memory_utilization", "enforce_eager", "limit_mm_per_prompt", "disable_mm_preprocessor_cache",
    "mm_processor_cache_gb", "mm_processor_cache_type", "mm_shm_cache_max_object_size_mb",
)
SAMPLING = {"temperature": 0.7, "top_p": 0.95, "max_tokens": 256, "stop": ["<|end|>", "<|endoftext|>", "<|im_end|>"], "repetition_penalty": 1.05, "skip_special_tokens": True}


def merged(base: dict, over: dict) -> dict:
    """``over`` on ``base``, dictionaries within dictionaries; None in ``over`` changes nothing."""
    out = dict(base)
    for key, value in over.items():
        if value is not None:
            out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def differing(old: dict, new: dict) -> list[str]:
    """Keys on one side only, or with other values, sorted."""
    return sorted(k for k in {*old, *new} if k not in old or k not in new or old[k] != new[k])


def reaction(old: dict | None, new: dict) -> str:
    """What a new configuration asks for: ``none``, ``runtime`` (settings of requests) or ``reload`` (of the engine; the first one too)."""
    if old is None:
        return "reload"
    keys = differing(old, new)
    return "none" if not keys else "reload" if any(k in RELOADING for k in keys) else "runtime"


def sampling(base: dict | None = None, stage: dict | None = None) -> dict:
    """Sampling settings: the defaults, under the base's, under the stage's."""
    return merged(merged(SAMPLING, base or {}), stage or {})


def accepted(function: Callable, arguments: dict) -> dict:
    """The arguments that a function takes by name; all of them where it takes any."""
    parameters = inspect.signature(function).parameters.values()
    if any(p.kind is p.VAR_KEYWORD for p in parameters):
        return dict(arguments)
    names = {p.name for p in parameters if p.kind in (p.POSITIONAL_OR_KEYWORD, p.KEYWORD_ONLY)}
    return {k: v for k, v in arguments.items() if k in names}
