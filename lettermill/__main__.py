"""Command line: ``python -m lettermill build|split|encode|style|compare|prompts|budget``.

Under ``spark-submit`` the session settings of the cluster apply.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.fixed_values import (
    ACCUMULATION,
    BATCH_SIZE,
    EPOCHS,
    MAX_LENGTH,
    SAMPLE_POOL,
    SECONDS_PER_STEP,
    SPLIT_SEED,
    TRAIN_RATIO,
)
from lettermill.operators.examples import assistant_texts
from lettermill.operators.language import LanguageModel
from lettermill.operators.reports import language_distribution, split_stats, training_budget
from lettermill.operators.chats import DEFAULT_TEMPLATE, default_prompts, prompt_grid, style_delta
from lettermill.operators.sequences import VOCABULARY_SIZE, build_vocab, encode_sequences
from lettermill.operators.style import full_style_report
from lettermill.plans.corpus import build_corpus, split_corpus
from lettermill.session import staged
from lettermill.sources.jsonl import read_examples, read_split, readable


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lettermill", description="Mailboxes to a chat corpus, and its style")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="mailboxes to a JSON-lines corpus, one folder per mailbox")
    build.add_argument("source")
    build.add_argument("output")
    build.add_argument("--labelled", required=True, help="Parquet table with text and lang to learn languages from")
    build.add_argument("--max-emails", type=int, help="first messages of every mailbox only")
    build.add_argument("--sample", action="store_true", help=f"first {SAMPLE_POOL} messages of every mailbox")
    build.add_argument("--any-name", action="store_true", help="read files that are not called mbox or *.mbox too")
    split = commands.add_parser("split", help="exact train and validation sets")
    split.add_argument("corpus")
    split.add_argument("output")
    split.add_argument("--train-ratio", type=float, default=TRAIN_RATIO)
    split.add_argument("--seed", type=int, default=SPLIT_SEED)
    style = commands.add_parser("style", help="writing-style report of a corpus")
    style.add_argument("corpus")
    encode = commands.add_parser("encode", help="fixed-length id sequences of a corpus, as Parquet, and their vocabulary")
    encode.add_argument("corpus")
    encode.add_argument("output")
    encode.add_argument("--vocabulary-size", type=int, default=VOCABULARY_SIZE)
    encode.add_argument("--max-length", type=int, default=MAX_LENGTH)
    compare = commands.add_parser("compare", help="style of two corpora side by side")
    compare.add_argument("left")
    compare.add_argument("right")
    prompts = commands.add_parser("prompts", help="what to send to each variant, as JSON lines")
    prompts.add_argument("output")
    prompts.add_argument("--prompts", help="text file with one prompt a line, instead of the default ones")
    budget = commands.add_parser("budget", help="training steps and hours for a corpus")
    budget.add_argument("corpus")
    budget.add_argument("--batch-size", type=int, default=BATCH_SIZE)
    budget.add_argument("--grad-accum", type=int, default=ACCUMULATION)
    budget.add_argument("--epochs", type=int, default=EPOCHS)
    budget.add_argument("--gpus", type=int, default=1)
    return parser.parse_args()


def _corpus(spark: SparkSession, path: str) -> DataFrame:
    """Readable examples of a corpus folder or file."""
    return readable(read_examples(spark, path)).select("messages", "metadata")


def _print(rows: DataFrame) -> None:
    """All rows of a report, tab-separated."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def _encode(spark: SparkSession, args: argparse.Namespace) -> None:
    chat = DEFAULT_TEMPLATE.render(F.col("messages"))
    texts = _corpus(spark, args.corpus).select(F.sha2(chat, 256).alias("text_sha256"), chat.alias("text"))
    vocab = staged(build_vocab(texts, size=args.vocabulary_size), "vocabulary")
    vocab.write.parquet(f"{args.output}/vocabulary")
    encode_sequences(texts, vocab, "text_sha256", max_length=args.max_length).write.parquet(f"{args.output}/sequences")


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.appName(f"lettermill-{args.command}").getOrCreate()
    if args.command == "build":
        model = LanguageModel.fit(spark.read.parquet(args.labelled))
        limit = SAMPLE_POOL if args.sample else args.max_emails
        _print(build_corpus(spark, args.source, args.output, model, limit, args.any_name))
        rows = read_examples(spark, args.output).select("metadata.language")
        _print(language_distribution(rows))
    elif args.command == "split":
        split_corpus(_corpus(spark, args.corpus), args.output, args.train_ratio, args.seed)
        sides = [read_split(spark, args.output, s).withColumn("split", F.lit(s)) for s in ("train", "validation")]
        rows = sides[0].unionByName(sides[1]).select("split", "metadata.word_count", "metadata.language")
        _print(split_stats(rows, n_words="word_count"))
        _print(language_distribution(rows, within=("split",)))
    elif args.command == "style":
        texts = staged(assistant_texts(_corpus(spark, args.corpus)), "texts").withColumn("id", F.xxhash64("text"))
        _print(full_style_report(texts, "id").orderBy("section", F.desc("value"), "item"))
    elif args.command == "encode":
        _encode(spark, args)
    elif args.command == "compare":
        sides = [assistant_texts(_corpus(spark, path)).withColumn("side", F.lit(s)) for s, path in (("l", args.left), ("r", args.right))]
        _print(style_delta(sides[0].unionByName(sides[1]), "side", "l", "r").orderBy("metric"))
    elif args.command == "prompts":
        given = default_prompts(spark) if not args.prompts else spark.read.text(args.prompts).withColumnRenamed("value", "prompt")
        prompt_grid(given).write.json(args.output)
    else:
        choice = (args.batch_size, args.grad_accum, args.gpus, args.epochs)
        _print(training_budget(_corpus(spark, args.corpus), [choice], SECONDS_PER_STEP))


if __name__ == "__main__":
    main()
