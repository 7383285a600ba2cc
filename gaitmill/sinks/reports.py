"""Markdown reports from statistics rows (collected: a few dozen rows at most)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

Rows = Sequence[Mapping[str, object]]


def collected(stats: DataFrame) -> list[dict]:
    """Statistics rows on the driver: totals, categories, bins and percentiles, whose
    number the configuration fixes. Longer summaries are tables, not text."""
    return [r.asDict(recursive=True) for r in stats.collect()]


def number(value) -> str:
    if value is None:
        return "0"
    return f"{value:,.2f}" if isinstance(value, float) else f"{value:,}"


def share(part, whole) -> str:
    return f"{100.0 * (part or 0) / whole:.1f}%" if whole else "0.0%"


def table(header: Sequence[str], rows: Iterable[Sequence[str]]) -> list[str]:
    lines = ["| " + " | ".join(header) + " |", "|---" + "|---:" * (len(header) - 1) + "|"]
    return [*lines, *("| " + " | ".join(str(c) for c in r) + " |" for r in rows), ""]


def total_and_parts(rows: Rows, name: str = "category") -> tuple[dict, list[dict]]:
    """Split rollup rows: the total has a null name."""
    total = next((dict(r) for r in rows if r[name] is None), {})
    return total, sorted((dict(r) for r in rows if r[name] is not None), key=lambda r: r[name])


def metric_section(title: str, values: Mapping[str, object]) -> list[str]:
    return [f"## {title}", "", *table(["metric", "value"], [(k, number(v)) for k, v in values.items()])]


def change_section(title: str, rows: Rows) -> list[str]:
    """Rows of ``before_after``."""
    body = [
        (
            r["metric"],
            number(r["before"]),
            f"**{number(r['after'])}**",
            f"{r['delta']:+,.2f} ({r['delta_percent']:+.1f}%)",
        )
        for r in rows
    ]
    return [f"## {title}", "", *table(["metric", "before", "after", "change"], body)]


def duration_section(title: str, histogram: Rows, percentiles: Rows, summary: Mapping) -> list[str]:
    bins = [(r["bin"], number(r["count"]), f"{r['percent']:.1f}%") for r in histogram]
    marks = ", ".join(f"p{r['percentile']:g}={r['value']:.2f}s" for r in percentiles)
    ends = ", ".join(f"{k}={summary[k]:.2f}s" for k in ("min", "max", "mean"))
    head = f"n={number(summary['n'])}, total={summary['total_h']:.2f} h"
    body = table(["bin (s)", "segments", "%"], bins)
    return [f"### {title}", "", head, "", *body, f"Percentiles: {marks}; {ends}.", ""]


def wash_report(counters: Rows, rule: Mapping, durations: Sequence[list[str]] = ()) -> str:
    g, categories = total_and_parts(counters)
    frames = g.get("input_frames") or 0
    overlap = g.get("overlap_frames") or 0
    kinds = {
        "crouch only": g["crouch_frames"] - overlap,
        "steering only": g["steering_frames"] - overlap,
        "crouch and steering": overlap,
        "union removed": g["bad_union_frames"],
    }
    per = [
        (c["category"], number(c["input_files"]), number(c["kept_segments"]),
         number(c["input_frames"]), number(c["output_frames"]),
         share(c["output_frames"], c["input_frames"]), f"{c['output_duration_s'] / 3600:.2f}")
        for c in [*categories, {**g, "category": "**total**"}]
    ]
    change = [
        ("segments", number(g["input_files"]), number(g["kept_segments"]),
         f"{g['kept_segments'] - g['input_files']:+,}"),
        ("frames", number(frames), number(g["output_frames"]),
         f"{g['output_frames'] - frames:+,} ({share(g['output_frames'] - frames, frames)})"),
        ("hours", f"{g['input_duration_s'] / 3600:.2f}", f"{g['output_duration_s'] / 3600:.2f}",
         f"{(g['output_duration_s'] - g['input_duration_s']) / 3600:+.2f}"),
    ]
    lines = ["# Crouch and steering wash", ""]
    lines += [f"- {k}: {v}" for k, v in rule.items()] + [""]
    lines += metric_section("Counts", {k: v for k, v in g.items() if k != "category"})
    lines += ["## Before and after", "", *table(["metric", "before", "after", "change"], change)]
    lines += ["## Bad frames", "", *table(["type", "frames", "% of input"],
              [(k, number(v), share(v, frames)) for k, v in kinds.items()])]
    header = ["category", "input", "output", "input frames", "output frames", "retained", "hours"]
    lines += ["## Per category", "", *table(header, per)]
    for section in durations:
        lines += section
    return "\n".join(lines).rstrip() + "\n"


def forward_report(counters: Rows, eps_back: float, solved: Mapping | None = None) -> str:
    g, categories = total_and_parts(counters)
    lines = ["# Forward-only filter", "", f"- a motion with any forward command below -{eps_back} is rejected", ""]
    lines += metric_section("Counts", {k: v for k, v in g.items() if k != "category"})
    per = [
        (c["category"], number(c["input_motions"]), number(c["kept_motions"]),
         number(c["backward_motions"]), number(c["input_frames"]), number(c["kept_frames"]),
         share(c["kept_frames"], c["input_frames"]))
        for c in categories
    ]
    header = ["category", "input", "kept", "rejected", "input frames", "kept frames", "retained"]
    lines += ["## Per category", "", *table(header, per)]
    if solved:
        lines += metric_section("Stage 3 subset", solved)
    return "\n".join(lines).rstrip() + "\n"


def balance_report(summaries: Rows, rule: Mapping, duration: list[str] | None = None) -> str:
    g = next(dict(r) for r in summaries if r["scope"] == "global")
    lines = ["# Minimum duration and stationary balance", ""]
    lines += [f"- {k}: {v}" for k, v in rule.items()] + [""]
    lines += metric_section("Counts", {k: v for k, v in g.items() if k not in ("scope", "name")})
    change = [
        (what, number(g[f"input_{part}"]), number(g[f"output_{part}"]),
         "-" + share(g[f"input_{part}"] - g[f"output_{part}"], g[f"input_{part}"]))
        for what, part in (("motions", "motions"), ("frames", "frames"), ("seconds", "duration_s"))
    ]
    lines += ["## Before and after", "", *table(["metric", "before", "after", "change"], change)]
    names = ("input", "duration_rejected", "moving", "stationary", "balance_rejected", "output")
    rows = sorted((r for r in summaries if r["scope"] == "category"), key=lambda r: str(r["name"]))
    body = [(r["name"], *[number(r[f"{n}_motions"]) for n in names]) for r in rows]
    lines += ["## Per category", "", *table(["category", *names], body)]
    lines += ["Totals per terrain are rows of the `stats` table.", ""]
    return "\n".join([*lines, *(duration or [])]).rstrip() + "\n"


def stages_report(sections: Sequence[list[str]], title: str = "Dataset preparation") -> str:
    """Report over all stages from the sections of each."""
    lines = [f"# {title}", ""]
    for s in sections:
        lines += [*s, "---", ""]
    return "\n".join(lines).rstrip() + "\n"


def write_text(spark, path: str, text: str) -> None:
    """One small text file on any file system, through Spark's commit protocol."""
    df = spark.createDataFrame([(text.rstrip("\n"),)], "value string")
    df.coalesce(1).write.mode("overwrite").text(path)


