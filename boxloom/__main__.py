"""``python -m boxloom JOB ...``: the jobs of ``boxloom.jobs`` from the command line."""

from __future__ import annotations

import argparse
import inspect
import typing

from pyspark.sql import SparkSession

from boxloom import filters, jobs, reports

JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (
        jobs.extract_urls, jobs.download, jobs.remove_duplicates, jobs.brightness, jobs.merge, jobs.split, jobs.label, jobs.add_plates, jobs.add_dataset, jobs.recover_plates, jobs.draw, jobs.crops,
        filters.triage, filters.validate, filters.relabel,
        reports.distribution, jobs.classification, jobs.metrics, reports.bad_predictions, reports.plate_errors, reports.review, reports.infer_draw,
    )
}


def _ratios(text: str) -> tuple[float, ...]:
    out = tuple(map(float, text.split(",")))
    if len(out) != 3:
        raise argparse.ArgumentTypeError("three shares are needed, such as 0.7,0.2,0.1")
    return out


def _names(text: str) -> dict[int, str]:
    return {int(k): v for k, _, v in (pair.partition(":") for pair in text.split(",") if pair)}


def _arguments(job) -> dict[str, tuple[object, object]]:
    """name: (type, default) of what a job takes besides the session; those of evaluations that it hands on included."""
    found: dict[str, tuple[object, object]] = {}
    for f in (job, jobs.sides if any(p.kind is p.VAR_KEYWORD for p in inspect.signature(job).parameters.values()) else None):
        if f is not None:
            hints = typing.get_type_hints(f)
            for name, p in inspect.signature(f).parameters.items():
                if name != "spark" and p.kind is not p.VAR_KEYWORD:
                    found[name] = (hints[name], p.default)
    return found


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="boxloom", description=__doc__)
    each = out.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        sub = each.add_parser(name, help=(job.__doc__ or "").split("\n")[0], description=job.__doc__)
        for arg, (kind, default) in _arguments(job).items():
            flag, more = f"--{arg.replace('_', '-')}", {"required": default is inspect.Parameter.empty, "default": None if default is inspect.Parameter.empty else default}
            if kind is bool:
                sub.add_argument(flag, action=argparse.BooleanOptionalAction, default=default)
            elif kind == list[str]:
                sub.add_argument(flag, nargs="+", **more)
            else:
                own = {"ratios": _ratios, "names": _names}.get(arg)
                bare = next((t for t in (typing.get_args(kind) or (kind,)) if t in (int, float, str)), str)
                sub.add_argument(flag, type=own or bare, choices=("front", "back") if arg == "orientation" else None, **more)
    return out


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    job = JOBS[args.pop("job")]
    spark = SparkSession.builder.appName("boxloom").getOrCreate()
    job(spark, **args).show(1000, truncate=False)


if __name__ == "__main__":
    main()
