"""Command line of the jobs, for ``spark-submit`` or ``python -m linkrank``."""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from linkrank import jobs

JOBS = {
    "build": jobs.build_job,
    "pagerank": jobs.pagerank_job,
    "components": jobs.components_job,
    "communities": jobs.communities_job,
    "analysis": jobs.analysis_job,
    "dump": jobs.dump_job,
}


def parser() -> argparse.ArgumentParser:
    """One sub-command per job; its options are the job's parameters."""
    top = argparse.ArgumentParser(prog="linkrank")
    commands = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, help=inspect.getdoc(job))
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            option = "--" + parameter.name.replace("_", "-")
            default = parameter.default
            if default is inspect.Parameter.empty:
                command.add_argument(option, required=True)
            elif default is False:
                command.add_argument(option, action="store_true")
            else:
                command.add_argument(option, type=type(default) if default else str, default=default)
    return top


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    job = JOBS[options.pop("job")]
    spark = SparkSession.builder.appName("linkrank").getOrCreate()
    for title, frame in (job(spark, **options) or {}).items():
        print(title)
        frame.show(100, truncate=False)


if __name__ == "__main__":
    main()
