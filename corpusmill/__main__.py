"""python -m corpusmill STAGE ARGS: run one stage from files to files."""

from __future__ import annotations

import argparse

from corpusmill.fixed_values import GEN_DEFAULT_ROWS
from corpusmill.plans import stages
from corpusmill.runtime import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusmill")
    top.add_argument("--master", help="Spark master; by default as spark-submit sets it")
    sub = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, run, *arguments: str) -> argparse.ArgumentParser:
        command = sub.add_parser(name)
        for argument in arguments:
            command.add_argument(argument)
        command.set_defaults(run=run)
        return command

    stage("parse", stages.parse, "root", "out").add_argument("--masked", action="store_true")
    dedupe = stage("dedupe", stages.remove_duplicates, "source", "out")
    for option in ("--index", "--batch"):
        dedupe.add_argument(option)
    stage("label", stages.add_labels, "source", "out")
    stage("corpus", stages.corpus, "source", "out")
    stage("prompts", stages.prompts, "source", "out").add_argument(
        "--n", type=int, default=GEN_DEFAULT_ROWS
    )
    pairs = stage("pairs", stages.make_pairs, "source", "out")
    for option in ("--prompt-table", "--completions", "--lint-results"):
        pairs.add_argument(option)
    stage("blocks", stages.blocks, "source", "out")
    stage("split", stages.split_pairs, "source", "out").add_argument("--near", action="store_true")
    stage("preferences", stages.preferences, "source", "out")
    stage("reward-prompts", stages.reward_prompts, "source", "out")
    stage("evaluate", stages.evaluate, "benchmark", "predictions", "out").add_argument(
        "--lint-results"
    )
    return top


def main(argv: list[str] | None = None) -> None:
    arguments = vars(parser().parse_args(argv))
    run, name = arguments.pop("run"), arguments.pop("stage")
    spark = session(f"corpusmill {name}", arguments.pop("master"))
    run(spark, **arguments).show(truncate=False)


if __name__ == "__main__":
    main()
