"""Command line: ``spark-submit ... -m clickfeat <job> <paths> [--option value]``."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import DataFrame, SparkSession

from clickfeat.plans import jobs
from clickfeat.workspace import release


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickfeat", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    for name in jobs.__all__:
        job = getattr(jobs, name)
        command = commands.add_parser(name.replace("_", "-"), help=inspect.getdoc(job))
        for arg, spec in list(inspect.signature(job).parameters.items())[1:]:
            if spec.default is inspect.Parameter.empty:
                command.add_argument(arg)
            elif isinstance(spec.default, float):
                command.add_argument(f"--{arg.replace('_', '-')}", type=float, default=spec.default)
            elif isinstance(spec.default, int) or arg in ("files", "limit"):
                command.add_argument(f"--{arg.replace('_', '-')}", type=int, default=spec.default)
            else:
                command.add_argument(f"--{arg.replace('_', '-')}", default=spec.default)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = vars(_parser().parse_args(argv))
    job = getattr(jobs, args.pop("job").replace("-", "_"))
    spark = SparkSession.builder.appName("clickfeat").getOrCreate()
    try:
        result = job(spark, **args)
        for part in result if isinstance(result, tuple) else (result,):
            if isinstance(part, DataFrame):
                part.show(100, truncate=False)
            elif part is not None:
                print(part)
    finally:
        release(spark)  # what the job has kept for itself


if __name__ == "__main__":
    main()
