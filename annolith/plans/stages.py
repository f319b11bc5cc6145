"""Stage chains: prompts to outputs by field, in dependency order, through a model adapter."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions.text import clean_output, render


@dataclass(frozen=True)
class Stage:
    name: str
    prompts: tuple[str, ...]
    output_field: str
    requires: tuple[str, ...] = ()
    model: str = ""


def parse_stages(config: dict) -> list[Stage]:
    """Stages of a configuration; without any, one named ``default`` with its prompts and the field ``captions``."""
    listed = config.get("stages") or []
    if not listed:
        return [Stage("default", tuple(config.get("inference_prompts") or ("describe this image",)), "captions", (), config.get("model", ""))]
    return [Stage(s["name"], tuple(s.get("prompts", ())), s.get("output_field", "captions"), tuple(s.get("requires", ())), s.get("model", config.get("model", ""))) for s in listed]


def in_order(stages: list[Stage]) -> list[Stage]:
    """Dependencies first, else as declared; an unknown dependency or a cycle is a ValueError."""
    by_name = {s.name: s for s in stages}
    if missing := {r for s in stages for r in s.requires} - set(by_name):
        raise ValueError(f"unknown stages: {sorted(missing)}")
    open_ = {s.name: len(set(s.requires)) for s in stages}
    ready, out = deque(s for s in stages if not open_[s.name]), []
    while ready:
        done = ready.popleft()
        out.append(done)
        for s in stages:
            if done.name in s.requires:
                open_[s.name] -= 1
                if not open_[s.name]:
                    ready.append(s)
    if len(out) < len(stages):
        raise ValueError("stages depend on each other in a circle")
    return out


def mock_output(stage: str, i: int, job_id: Column, item_key: Column) -> Column:
    return F.concat(F.lit(f"Mock {stage} output {i} for job "), job_id, F.lit(" - "), item_key)


def mock_outputs(items: DataFrame, stages: list[Stage], job_id: str = "job_id", item_key: str = "item_key") -> DataFrame:
    """``items`` and a map field -> outputs of the deterministic mock; natively, in one projection."""
    fields: dict[str, list[Column]] = {}
    for stage in in_order(stages):
        made = [mock_output(stage.name, i, F.col(job_id), F.col(item_key)) for i in range(1, len(stage.prompts) + 1)]
        fields.setdefault(stage.output_field, []).extend(made)
    pairs = [x for f, made in fields.items() for x in (F.lit(f), F.array(*made))]
    return items.withColumn("outputs", F.create_map(*pairs))


class Adapter(Protocol):
    """A model: prompts of a batch in, texts out. Made once in each worker."""

    def __call__(self, prompts: list[str], batch: pd.DataFrame) -> list[str]: ...


_models: dict[str, Adapter] = {}


def run_stages(items: DataFrame, stages: list[Stage], make_adapter, columns: dict[str, str] | None = None) -> DataFrame:
    """``items`` with the list column of each output field, filled by ``make_adapter(model)`` stage by stage.

    Each prompt is rendered natively from the item's columns, the outputs so far (``<stage>_output_<i>``) and the field's
    (the text alone where there is one, else the list). Outputs are cleaned; empty ones are dropped; stages that share a
    field are joined in order of completion.
    """
    out, context = items, dict(columns or items.dtypes)
    fields: dict[str, list[str]] = {}
    for stage in in_order(stages):
        made = []
        for i, prompt in enumerate(stage.prompts, 1):
            name = f"{stage.name}_output_{i}"
            asked = out.withColumn("_prompt", render(prompt, context))

            def infer(batches: Iterator[pd.DataFrame], model=stage.model, name=name) -> Iterator[pd.DataFrame]:
                adapter = _models.setdefault(model, make_adapter(model))
                for batch in batches:
                    batch[name] = adapter(batch["_prompt"].tolist(), batch)
                    yield batch.drop(columns="_prompt")

            schema = ", ".join(f"`{n}` {k}" for n, k in [*out.dtypes, (name, "string")])
            out = asked.mapInPandas(infer, schema).withColumn(name, F.nullif(clean_output(F.col(name)), F.lit("")))
            made.append(name)
            context[name] = "string"
        fields.setdefault(stage.output_field, []).extend(made)
        whole = F.array_compact(F.array(*fields[stage.output_field]))
        out = out.withColumn(stage.output_field, whole)
        context[stage.output_field] = "array<string>"
    return out


def unit_outcome(size: Column, processed: Column, failed: Column) -> Column:
    return F.when((failed == 0) & (processed >= size), "completed").otherwise("failed")


def buffer_need(workers: Column, waiting: Column, *, least: int = 10, each: int = 3) -> Column:
    """Units to make so that max(least, workers * each) wait or are worked on."""
    return F.greatest(F.lit(0), F.greatest(F.lit(least), workers * each) - waiting)
