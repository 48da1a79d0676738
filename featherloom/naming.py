"""Names of derived columns, and the codec of run names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """Column by exact name; generated names may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def aggregate_name(header: str, column: str, function: str) -> str:
    return f"{header}_{column}_{function.upper()}"


def count_name(header: str, keys: list[str]) -> str:
    return f"{header}_COUNT_{'_'.join(keys)}"


def dummy_name(column: str, value: object | None) -> str:
    return f"{column}_nan" if value is None else f"{column}_{value}"


def row_stat_name(header: str, method: str) -> str:
    return f"{header}_{method.upper()}"


def component_name(name: str, index: int) -> str:
    return f"{name}_{index}"


def pair_name(a: str, b: str) -> str:
    return f"{a}_X_{b}"


def meta_name(stacker: str, index: int) -> str:
    return f"{stacker}_{index}"


# The public run-name format and its timestamp pattern.
RUN_NAME_FORMAT = "level[%d]_%s_features[%04d]_score[%.6f]_fold[%d]_%s"
RUN_NAME_TIME = "yyyy-MM-dd-HH-mm"


def format_run_name(level: Column, model: Column, feature_num: Column,
                    score: Column, fold: Column, timestamp: Column) -> Column:
    """Run name of each row; missing parts take the codec's defaults."""
    return F.format_string(
        RUN_NAME_FORMAT,
        F.coalesce(level.cast("int"), F.lit(0)),
        F.coalesce(model, F.lit("unknown")),
        F.coalesce(feature_num.cast("int"), F.lit(0)),
        F.coalesce(score.cast("double"), F.lit(0.0)),
        F.coalesce(fold.cast("int"), F.lit(0)),
        F.date_format(timestamp, RUN_NAME_TIME),
    )


def run_folder(name: str) -> str:
    """A run name as a folder name: readers take square brackets for a pattern."""
    return name.replace("[", "(").replace("]", ")")


def parse_run_name(name: Column) -> dict[str, Column]:
    """Columns read back from a run name, also with a prefix or file ending.

    Anchored on the brackets, so a model name may itself contain ``_``.
    """
    pattern = (r"level\[(\d+)\]_(.*)_features\[(\d+)\]_score\[([-+0-9.einfa]+)\]"
               r"_fold\[(\d+)\]_(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})")

    def part(i: int) -> Column:
        text = F.regexp_extract(name, pattern, i)
        return F.when(text != "", text)

    return {
        "level": part(1).cast("int"),
        "model": part(2),
        "feature_num": part(3).cast("int"),
        "score": part(4).cast("double"),
        "fold": part(5).cast("int"),
        "timestamp": F.to_timestamp_ntz(part(6), F.lit(RUN_NAME_TIME)),
    }
