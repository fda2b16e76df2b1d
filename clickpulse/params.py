"""Parameters of the batch jobs, stored as a JSON object next to each task."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.text import not_blank, strip_blanks


@dataclass(frozen=True)
class JobParams:
    """Filters of one task. ``None`` or an empty tuple means "no predicate"."""

    start_date: str | None = None
    end_date: str | None = None
    sex: str | None = None
    professionals: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str | None) -> JobParams:
        """Parse a task's JSON parameters; a missing or empty object is an error."""
        fields = json.loads(text) if text and text.strip() else None
        if not isinstance(fields, dict) or not fields:
            raise ValueError("the task has no parameters")
        return cls(
            start_date=_given(fields, "startDate"),
            end_date=_given(fields, "endDate"),
            sex=_given(fields, "sex"),
            professionals=split_list(_given(fields, "professionals")),
        )

    @property
    def needs_users(self) -> bool:
        """Whether the user table takes part at all."""
        return self.sex is not None or bool(self.professionals)


def split_list(text: str | None) -> tuple[str, ...]:
    """Items of a comma list, untrimmed, without the blank ones."""
    return tuple(item for item in (text or "").split(",") if item.strip())


def _given(fields: dict, name: str) -> str | None:
    value = fields.get(name)
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value)
    return text if text.strip() else None


def task_params(tasks: DataFrame) -> DataFrame:
    """The parameters of many tasks as columns, by the rules of ``JobParams.from_json``.

    Adds to ``task_id``: refused (no object, or an empty one), start_date, end_date, sex
    and professionals (an array). A parameter that is missing or blank is null, a list
    without items empty; a refused task has none.
    """
    fields = F.from_json("task_param", "map<string, string>")
    whole = strip_blanks(F.col("task_param")).startswith("{")
    parsed = tasks.select("task_id", F.when(whole, fields).alias("fields"))
    professionals = F.filter(
        F.split(F.coalesce(_column("professionals"), F.lit("")), ","), lambda item: not_blank(item)
    )
    return parsed.select(
        "task_id",
        (F.coalesce(F.size("fields"), F.lit(0)) <= 0).alias("refused"),
        _column("startDate").alias("start_date"),
        _column("endDate").alias("end_date"),
        _column("sex").alias("sex"),
        professionals.alias("professionals"),
    )


def _column(name: str) -> Column:
    value = F.col("fields")[name]
    return F.when(not_blank(value), value)
