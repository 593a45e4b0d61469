"""spark-submit entry: prepare, train, infer, evaluate.

    python -m facetide prepare --imdb meta.parquet --base_path data --out records
    python -m facetide train --path records/train --model models --featurize my_module:make_features
    python -m facetide infer --path records/test --model models --output predictions
    python -m facetide evaluate --path records/test --model models --choose_best
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from facetide.operators.models import latest_checkpoint, load_model
from facetide.operators.prep import union_corpora
from facetide.plans import evaluate as evaluation, infer as inference, prepare as preparation, train as training
from facetide.sources.tables import read_meta


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="facetide", description=__doc__.splitlines()[0])
    modes = parser.add_subparsers(dest="mode", required=True)

    p = modes.add_parser("prepare", help="metadata and images to training and test records")
    p.add_argument("--imdb", help="metadata of the imdb corpus")
    p.add_argument("--wiki", help="metadata of the wiki corpus")
    p.add_argument("--format", default="parquet", help="of the metadata: parquet or csv")
    p.add_argument("--base_path", default="./data", help="directory with the corpora's image folders")
    p.add_argument("--out", help="directory of the records; default: the base path")
    p.add_argument("--test_size", type=float, default=preparation.TEST_SIZE, help="share of rows to test with")
    p.add_argument("--nworks", type=int, default=preparation.WORKERS, help="number of training shards")
    p.add_argument("--detect", help="module:function from image bytes to a list of aligned faces")
    p.add_argument("--second_face", action="store_true", help="also drop images with a second face")

    def with_data(p: argparse.ArgumentParser) -> None:
        p.add_argument("--path", required=True, help="directory of records")
        p.add_argument("--model", default="models", help="directory of checkpoints")
        p.add_argument("--format", default="tfrecord", help="of the records: tfrecord or parquet")
        p.add_argument("--featurize", help="module:function that makes the function from images to features")

    p = modes.add_parser("train", help="train the two heads")
    with_data(p)
    p.add_argument("--learning_rate", "--lr", type=float, default=1e-3)
    p.add_argument("--weight_decay", type=float, default=1e-5,
                   help="accepted, without effect: it is for the network that makes the features; the heads' decay is fixed")
    p.add_argument("--steps", type=int, default=1000, help="maximum number of steps; 0: every full batch")
    p.add_argument("--epochs", type=int, default=6)
    p.add_argument("--batch_size", type=int, default=128)
    p.add_argument("--log_path", default="train_log", help="metric log")
    p.add_argument("--full_batch", action="store_true", help="fit on the whole data at once")

    p = modes.add_parser("infer", help="write predictions of the newest checkpoint as text")
    with_data(p)
    p.add_argument("--output", default="predictions")
    p.add_argument("--num-partitions", type=int, help="number of output files")

    p = modes.add_parser("evaluate", help="age error, gender accuracy and loss")
    with_data(p)
    p.add_argument("--batch_size", type=int, default=evaluation.TEST_BATCH)
    p.add_argument("--choose_best", action="store_true", help="test all checkpoints and report the best")
    return parser.parse_args(argv)


def hook(name: str | None):
    if name is None:
        return None
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


def newest(spark: SparkSession, directory: str):
    path = latest_checkpoint(spark, directory)
    if path is None:
        raise FileNotFoundError(f"no trained model in {directory}")
    return load_model(spark, path)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"facetide-{args.mode}").getOrCreate()
    if args.mode == "prepare":
        corpora = [
            read_meta(spark, path, source, args.format, **({"header": True} if args.format == "csv" else {}))
            for source, path in (("imdb", args.imdb), ("wiki", args.wiki)) if path
        ]
        if not corpora:
            raise SystemExit("choose at least one of --imdb and --wiki")
        preparation.prepare(
            union_corpora(*corpora), args.base_path, args.out or args.base_path, args.test_size, args.nworks,
            hook(args.detect), second_face=args.second_face,
        ).show()
        return
    rows = training.load_features(spark, args.path, hook(args.featurize), args.format)
    if args.mode == "train" and args.full_batch:
        training.train(rows, args.model, full_batch=True)
    elif args.mode == "train":
        training.train(
            rows, args.model, args.log_path, epochs=args.epochs, steps=args.steps or None, batch_size=args.batch_size,
            lr=args.learning_rate, weight_decay=args.weight_decay,
        )
    elif args.mode == "infer":
        inference.infer(rows, newest(spark, args.model), args.output, num_partitions=args.num_partitions)
    elif args.choose_best:
        best, results = evaluation.choose_best_model(rows, args.model, batch_size=args.batch_size)
        results.orderBy("idx").show(truncate=False)
        best.show(truncate=False)
    else:
        evaluation.evaluate(rows, newest(spark, args.model), batch_size=args.batch_size).show()


if __name__ == "__main__":
    main()
