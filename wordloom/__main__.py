"""Run one job: python -m wordloom JOB ARGUMENTS."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wordloom.plans import jobs


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="wordloom")
    jobs_of = main.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, text: bool = True) -> argparse.ArgumentParser:
        sub = jobs_of.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        if text:
            sub.add_argument("--skip-patterns", dest="stop_files", action="append", default=[])
            sub.add_argument("--case-sensitive", action="store_true")
        return sub

    job("word_count", "corpus", "output")
    job("top", "counts", "output", text=False).add_argument("-k", type=int, default=50)
    for name in ("pairs", "stripes"):
        sub = job(name, "corpus", "vocabulary", "output")
        sub.add_argument("-d", type=int, default=1)
        if name == "stripes":
            sub.add_argument("--sparse", action="store_true")
    job("document_frequency", "corpus", "output").add_argument("--no-stem", dest="stem", action="store_false")
    scores = job("tf_idf", "corpus", "frequencies", "output")
    scores.add_argument("--no-stem", dest="stem", action="store_false")
    scores.add_argument("--n-docs", type=int)
    scores.add_argument("--running", action="store_true")
    scores.add_argument("--sparse", action="store_true")
    return main


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    run = getattr(jobs, options.pop("job"))
    run(SparkSession.builder.getOrCreate(), **options)


if __name__ == "__main__":
    main()
