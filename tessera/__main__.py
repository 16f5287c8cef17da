"""Linking projects from the command line: python -m tessera COMMAND --base FOLDER [--split SPLIT] ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.blocking import BlockConfig
from tessera.plans.project import Project, Settings

COMMANDS = "normalize index candidates recall pairs features train score threshold write evaluate validate sample fit link".split()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--base", required=True, help="folder of the project")
    p.add_argument("--split", default="train")
    p.add_argument("--model-split", default="train")
    blocks, rest = BlockConfig(), Settings()
    for name in ("k", "rare_max_df", "addr_max_df", "max_df", "min_df", "max_cluster", "rare_tokens"):
        p.add_argument("--" + name.replace("_", "-"), type=int, default=getattr(blocks, name))
    p.add_argument("--no-scale", dest="scale", action="store_false", help="take the frequency cut-offs as given")
    for name in ("val", "per_pos", "seed", "trees", "depth", "rate", "shard_rows"):
        p.add_argument("--" + name.replace("_", "-"), type=type(getattr(rest, name)), default=getattr(rest, name))
    p.add_argument("--early-stopping", dest="patience", type=int, default=rest.patience, help="rounds without a gain that end boosting")
    p.add_argument("--min-data-in-leaf", dest="leaf", type=int, default=rest.leaf)
    p.add_argument("--num-leaves", type=int, help="in place of --depth: the least depth with so many leaves")
    p.add_argument("--linear", action="store_true", help="logistic regression in place of boosted trees")
    p.add_argument("--of", choices=["candidates", "pairs"], default="candidates", help="rows to make features of")
    p.add_argument("--val-only", action="store_true")
    p.add_argument("--threshold", type=float)
    p.add_argument("--gate", action="store_true", help="fail below the required recall")
    p.add_argument("--matching", help="match list to evaluate or validate")
    p.add_argument("--candidate", help="candidate list to validate")
    p.add_argument("--out-dir", help="folder to write lists to")
    p.add_argument("--out", help="folder to write the score report to")
    p.add_argument("--check-ids", action="store_true", help="validate: also look ids up among the targets")
    p.add_argument("--to", default="dev", help="split to write a sample to")
    for name, n in (("matched", 6000), ("single", 2000), ("many", 2000), ("extra", 120_000)):
        p.add_argument(f"--{name}", type=int, default=n)
    return p


def run(spark: SparkSession, argv: list[str]) -> DataFrame | float | None:
    a = parser().parse_args(argv)
    blocks = BlockConfig(a.max_cluster, a.rare_max_df, a.addr_max_df, a.rare_tokens, a.min_df, a.max_df, a.k)
    depth = a.depth if a.num_leaves is None else max(1, (a.num_leaves - 1).bit_length())
    project = Project(spark, a.base, Settings(blocks, a.scale, a.val, a.per_pos, a.seed, a.trees, depth, a.rate, a.leaf, a.patience, a.linear, a.shard_rows))
    steps = {
        "normalize": lambda: (project.queries(a.split), project.targets(a.split))[0],
        "index": lambda: project.index(a.split)[0]["vocab"],
        "candidates": lambda: project.candidates(a.split),
        "recall": lambda: project.recall(a.split, a.gate),
        "pairs": lambda: project.pairs(a.split),
        "features": lambda: project.features(a.split, a.of, a.val_only),
        "train": lambda: project.train(a.split),
        "score": lambda: project.scores(a.split, a.model_split, a.val_only),
        "threshold": lambda: project.threshold(a.split),
        "write": lambda: project.write(a.split, a.model_split, a.threshold, a.out_dir),
        "evaluate": lambda: project.evaluate(a.split, a.matching, a.out),
        "validate": lambda: project.validate(a.split, a.matching, a.candidate, a.check_ids),
        "sample": lambda: project.sample(a.split, a.to, a.matched, a.single, a.many, a.extra),
        "fit": lambda: project.fit(a.split, a.gate),
        "link": lambda: project.link(a.split, a.model_split, a.threshold),
    }
    return steps[a.command]()


def main() -> None:
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    try:
        result = run(spark, sys.argv[1:])
        result.show(50, truncate=False) if isinstance(result, DataFrame) else print(result)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
