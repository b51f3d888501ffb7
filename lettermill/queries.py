"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads whole driver tables, or data that Spark derives from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions import cleaning, mime
from lettermill.functions.fixed_values import (
    ACCUMULATION,
    BATCH_SIZE,
    EPOCHS,
    PHRASE_DISPLAY_CHARS,
    SAMPLE_DISPLAY_CHARS,
    SECONDS_PER_STEP,
    STOP_WORDS,
    TOP_WORDS,
)
from lettermill.functions.html import html_to_text
from lettermill.functions.text import ellipsize, plain_words, word_count
from lettermill.operators import bodies, chats, examples, filtering, grouped_split as grouping, language, reports, sequences, signoffs, significance, sketches, splitting, style
from lettermill.plans.corpus import build_corpus
from lettermill.plans.incremental import update_corpus
from lettermill.session import scratch_path, staged
from lettermill.sources import jsonl, mailbox
from lettermill.streaming import counters as stream
from lettermill.views import emails, mail_records, parts, table, turns

Query = Callable[[SparkSession, str], DataFrame]

BUDGETS = [
    (BATCH_SIZE, ACCUMULATION, 1, EPOCHS),
    (BATCH_SIZE, ACCUMULATION, 2, EPOCHS),
    (1, ACCUMULATION, 1, EPOCHS),
    (1, ACCUMULATION, 2, 1),
]
FIRST_PER_SOURCE = 20
LARGE_PER_SOURCE = 1_200
WORDS_KEPT = 300
STREAM_PER_SOURCE = 30


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _joined(array: str) -> Column:
    return F.array_join(F.col(array).cast("array<string>"), " ").alias(array)


# --- sources and sinks -----------------------------------------------------------


def _mailboxes(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "mailboxes")
    mailbox.write_mailboxes(mail_records(spark, sf_dir), path, "source", "doc_id")
    return path


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = mailbox.stage_messages(spark, _mailboxes(spark, sf_dir), scratch_path(spark, "messages"))
    return mailbox.with_message_index(staged)


def _box_name(source: str = "source") -> Column:
    return F.regexp_extract(source, "source=([^/]+)$", 1)


def mbox_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = bodies.header_projection(_messages(spark, sf_dir))
    return messages.select(
        _box_name().alias("mailbox"), "msg_idx", "subject", "to_addr", F.size("parts").alias("n_parts"), "error"
    )


def mbox_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mailbox.find_mailboxes(spark, _mailboxes(spark, sf_dir))
    return found.groupBy(_box_name().alias("mailbox")).agg((F.sum("length") > 0).alias("has_mail"))


def mime_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mailbox.part_rows(_messages(spark, sf_dir), "source", "msg_idx")
    return rows.select(
        _box_name().alias("mailbox"),
        "msg_idx",
        "part_no",
        "content_type",
        "disposition",
        mime.decode_utf8(F.col("payload")).alias("payload"),
    )


def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    return build_corpus(spark, _mailboxes(spark, sf_dir), scratch_path(spark, "corpus"), model)


def corpus_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the build wrote: mailbox, subject and text of every example."""
    path = scratch_path(spark, "corpus")
    build_corpus(spark, _mailboxes(spark, sf_dir), path, _model(spark, sf_dir))
    read = jsonl.read_examples(spark, path)
    return read.select(
        F.regexp_extract("mailbox", "^(.*)-[0-9a-f]{8}$", 1).alias("mailbox"),
        F.col("metadata.subject").alias("subject"),
        F.element_at("messages", -1)["content"].alias("content"),
        F.col("metadata.word_count").alias("word_count"),
    )


def corpus_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus after a first build and an update: some mailboxes got the messages that were left out at first."""
    records, boxes, path = mail_records(spark, sf_dir), scratch_path(spark, "mailboxes"), scratch_path(spark, "corpus")
    model, late = _model(spark, sf_dir), F.col("doc_id") % 3 == 0
    mailbox.write_mailboxes(records.filter(~late), boxes, "source", "doc_id")
    update_corpus(spark, boxes, path, model)
    grown = F.ascii(F.substring_index("source", ".mbox", 1).substr(-1, 1)) % 2 == 0
    mailbox.write_mailboxes(records.filter(late & grown), boxes, "source", "doc_id", mode="append")
    stats = update_corpus(spark, boxes, path, model)
    read = jsonl.read_examples(spark, path).groupBy(F.regexp_extract("mailbox", "^(.*)-[0-9a-f]{8}$", 1).alias("mailbox")).agg(
        F.count(F.lit(1)).alias("examples"), F.sum("metadata.word_count").cast("long").alias("words")
    )
    return read.join(F.broadcast(stats.select("total", "processed", "total_words", "rebuilt", "removed")))  # one row


def examples_any_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples with keys of their own, without metadata and cut off, read, written and read again."""
    first, second = scratch_path(spark, "any-shape"), scratch_path(spark, "any-shape")
    text, number = F.col("text"), F.col("doc_id")
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    messages = F.array(turn("user", F.col("source")), turn("assistant", text)).alias("messages")
    mark = F.struct(number.alias("n"), F.array(F.lit("a"), F.col("lang")).alias("tags")).alias("mark")
    metadata = F.struct(F.col("lang").alias("language"), F.concat(F.lit("Subject "), number).alias("subject"), mark).alias("metadata")
    shapes = [F.to_json(F.struct(*c)) for c in ((number, messages, metadata), (messages, number), (number, messages))]
    kind = number % 4
    line = F.when(kind == 0, shapes[0]).when(kind == 1, shapes[1]).when(kind == 2, F.concat(F.lit("[1, "), shapes[2])).otherwise(shapes[2])
    _documents(spark, sf_dir).select(line.alias("value")).write.text(first)
    jsonl.write_any_shape(jsonl.read_any_shape(spark, first), second)
    rejects = jsonl.read_any_shape(spark, first).filter("value is null").agg(F.count(F.lit(1)).alias("n_rejects"))
    read = jsonl.known_fields(jsonl.read_any_shape(spark, second)).select(
        F.variant_get("value", "$.doc_id", "bigint").alias("doc_id"), "metadata.language", "metadata.subject",
        F.element_at("messages", -1)["content"].alias("content"), F.size("messages").alias("n_messages"),
        F.try_variant_get("value", "$.metadata.mark.tags[1]", "string").alias("tag"),
        F.try_variant_get("value", "$.metadata.mark.n", "bigint").alias("mark"),
    )
    return read.join(F.broadcast(rejects))  # one row


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "examples")
    jsonl.write_examples(_examples(spark, sf_dir), path)
    read = jsonl.read_examples(spark, path)
    return read.select(
        F.col("metadata.subject").alias("subject"),
        F.col("metadata.language").alias("language"),
        F.col("metadata.word_count").alias("word_count"),
        F.posexplode("messages").alias("turn", "message"),
    ).select("subject", "language", "word_count", "turn", "message.role", "message.content")


def write_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    corpus = staged(_examples(spark, sf_dir, "doc_id"), "examples")
    rows = splitting.train_val_split(corpus, "doc_id")
    jsonl.write_examples(rows.drop("doc_id"), path, by="split")
    sides = [
        jsonl.read_split(spark, path, side).withColumn("split", F.lit(side))
        for side in (splitting.TRAIN, splitting.VALIDATION)
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("examples"), F.sum("metadata.word_count").cast("long").alias("total_words"))
    )


# --- bodies -------------------------------------------------------------------------


def header_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("subject"), F.lit("\t"))
    headers = F.when(F.col("to_addr") == "", F.create_map(F.lit("Subject"), padded)).otherwise(
        F.create_map(F.lit("Subject"), padded, F.lit("To"), F.col("to_addr"))
    )
    messages = emails(spark, sf_dir).select("doc_id", headers.alias("headers"))
    return bodies.header_projection(messages).drop("headers")


def drop_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bodies.drop_attachments(parts(spark, sf_dir)).drop("multipart")


def choose_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _documents(spark, sf_dir).select(F.col("doc_id").alias("msg_id"))
    return bodies.choose_body(messages, parts(spark, sf_dir))


def decode_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    damaged = F.concat(text, F.unhex(F.lit("FF")), text, F.unhex(F.lit("C3")))
    return _documents(spark, sf_dir).select("doc_id", mime.decode_utf8(damaged).alias("text"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


# --- cleaning ---------------------------------------------------------------------------


def _rule(rule: Callable[[Column], Column], view: str = "emails", column: str = "body") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = emails(spark, sf_dir) if view == "emails" else table(spark, sf_dir, view)
        return rows.select("doc_id", rule(F.col(column)).alias("text"))

    return query


def learned_sign_offs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every e-mail without the lines that its source puts below many of them."""
    rows = emails(spark, sf_dir).select("doc_id", "source", F.col("body").alias("text"))
    return signoffs.cut_sign_offs(rows, "source").drop("source")


# --- filters and metrics ------------------------------------------------------------------


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.with_status(emails(spark, sf_dir))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("doc_id", "n_words", "status")


def min_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtering.accepted(emails(spark, sf_dir)).select("doc_id", "n_words")


def head_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select("source", "doc_id", "text")
    return filtering.first_n_per_group(rows, "source", "doc_id", FIRST_PER_SOURCE)


def head_per_source_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit over 1,000, with half of the rows in the group without a source, and ids over the whole range of long."""
    rows = _documents(spark, sf_dir).select(
        F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"),
        F.expr("(doc_id - 500) * 9000000000001").alias("place"),
        "doc_id",
    )
    return filtering.first_n_per_group(rows, "source", "place", LARGE_PER_SOURCE)


def words_per_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", word_count(F.col("text")).alias("n_words"))


# --- language -----------------------------------------------------------------------------------


def _model(spark: SparkSession, sf_dir: str) -> language.LanguageModel:
    return language.LanguageModel.fit(_documents(spark, sf_dir))


def lang_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.word_profile(_documents(spark, sf_dir))


def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected = _model(spark, sf_dir).with_language(_documents(spark, sf_dir), "text")
    return detected.select("doc_id", "lang", "lang_detected")


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted e-mails with their detected language."""
    rows = _model(spark, sf_dir).with_language(filtering.accepted(emails(spark, sf_dir)), "clean")
    return rows.withColumn("language", language.map_language(F.col("lang_detected")))


def map_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("doc_id", "language")


def language_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.language_indicators(_documents(spark, sf_dir), "source")


# --- examples -----------------------------------------------------------------------------------------


def _examples(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return examples.build_examples(_accepted(spark, sf_dir), keep=keep)


def user_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = examples.user_prompt(F.col("subject"), F.col("to_addr"))
    return emails(spark, sf_dir).select("doc_id", prompt.alias("prompt"))


def build_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _examples(spark, sf_dir, "doc_id").select(
        "doc_id",
        *[F.col("messages")[i]["content"].alias(f"{role}_text") for i, role in enumerate(("system", "user", "assistant"))],
        "metadata.*",
    )


def assistant_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = turns(spark, sf_dir).filter(F.col("role") == "assistant")
    return said.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))


def nested_assistant_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = chats.nest_turns(turns(spark, sf_dir))
    return examples.assistant_texts(nested, ("conv_id",)).select("conv_id", "turn", "text")


def cut_for_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select(
        "doc_id",
        ellipsize(F.col("text"), PHRASE_DISPLAY_CHARS).alias("phrase"),
        ellipsize(F.col("text"), SAMPLE_DISPLAY_CHARS).alias("sample"),
    )


# --- reports ----------------------------------------------------------------------------------------------


def processing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.processing_stats(_judged(spark, sf_dir))


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over the first e-mails of every source, read as a stream that stops between the halves of its input."""
    rows = emails(spark, sf_dir).select("source", F.col("doc_id").alias("place"), "body")
    middle = rows.agg(F.percentile_approx("place", 0.5)).first()[0] or 0
    arrived, counted, state = (scratch_path(spark, name) for name in ("arrived", "counted", "stream-state"))
    for half in (rows.filter(F.col("place") < middle), rows.filter(F.col("place") >= middle)):
        half.write.mode("append").parquet(arrived)
        arriving = filtering.with_status(spark.readStream.schema(rows.schema).parquet(arrived))
        stream.write_counters(stream.mailbox_counters(arriving, STREAM_PER_SOURCE), counted, state).awaitTermination()
    return stream.latest_counters(spark, counted)


def language_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.language_distribution(_accepted(spark, sf_dir))


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = staged(filtering.accepted(emails(spark, sf_dir)).select("doc_id", "n_words"), "accepted")
    return reports.split_stats(splitting.train_val_split(accepted, "doc_id"))


def split_language_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = staged(_accepted(spark, sf_dir).select("doc_id", "language"), "accepted")
    return reports.language_distribution(splitting.train_val_split(accepted, "doc_id"), within=("split",))


def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.split_sizes(splitting.train_val_split(_documents(spark, sf_dir), "doc_id"))


def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.text_counts(_turns(spark, sf_dir), "role")


def training_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.training_budget(_turns(spark, sf_dir).select("conv_id").distinct(), BUDGETS, SECONDS_PER_STEP)


# --- style ----------------------------------------------------------------------------------------------------


def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.length_stats(_documents(spark, sf_dir), "source")


def formality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.formality_counts(emails(spark, sf_dir), text="body")


def formality_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.formality_counts(emails(spark, sf_dir), "source", text="body").select("source", "label")


def punctuation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.punctuation_stats(_documents(spark, sf_dir), "source")


def top_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.top_openings(_documents(spark, sf_dir))


def top_closings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.top_closings(_documents(spark, sf_dir))


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.top_words(_documents(spark, sf_dir))


def merged_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent words of every source, from summaries kept per source and language."""
    words = _documents(spark, sf_dir).select("source", "lang", F.explode(plain_words(F.col("text"))).alias("word"))
    kept = sketches.frequent_items(words.filter(~F.col("word").isin(STOP_WORDS)), ["source", "lang"], "word", WORDS_KEPT)
    return sketches.most_frequent(sketches.merged_items(kept, ["source"], WORDS_KEPT), ["source"], TOP_WORDS)


def length_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the lengths of every source's texts, from summaries kept per source and language."""
    kept = sketches.length_sketches(_documents(spark, sf_dir), ["source", "lang"])
    return sketches.length_quantiles(sketches.merged_lengths(kept, ["source"]), ["source"])


def sample_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.sample_texts(_documents(spark, sf_dir), "doc_id")


def style_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.style_report(emails(spark, sf_dir), text="body")


def full_style_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.full_style_report(emails(spark, sf_dir), "doc_id", text="body")


def style_report_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style.style_report(_documents(spark, sf_dir), "source")


# --- order and split ---------------------------------------------------------------------------------------------


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.seeded_shuffle(_documents(spark, sf_dir), "doc_id").select("doc_id", "position")


def grouped_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts equal but for case and punctuation, and those that begin with the same line of five words, stay together."""
    docs = _documents(spark, sf_dir)
    plain = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    opening = plain(F.split("text", "\n")[0])
    keys = [F.nullif(plain(F.col("text")), F.lit("")), F.when(F.size(F.split(opening, " ")) >= 5, opening)]
    return grouping.grouped_split(docs, "doc_id", [F.md5(k.cast("binary")) for k in keys]).select("doc_id", "group_id", "split")


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.train_val_split(_documents(spark, sf_dir), "doc_id").select("doc_id", "split")


# --- conversations and sequences ------------------------------------------------------------------------------------


def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.render_chat(turns(spark, sf_dir))


ROLE_TEMPLATE = chats.ChatTemplate(
    turn_open="[{role}] ", turn_close="\n", begin="<s>", roles=(("user", "[INST] ", " [/INST]"), ("assistant", " ", "</s>"))
)


def render_chat_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.render_chat(turns(spark, sf_dir), ROLE_TEMPLATE)


def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.build_vocab(_documents(spark, sf_dir))


def encode_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    encoded = sequences.encode_sequences(documents, sequences.build_vocab(documents), "doc_id")
    return encoded.select("doc_id", _joined("input_ids"), _joined("attention_mask"), _joined("labels"))


def decode_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    vocab = sequences.build_vocab(documents)
    return sequences.decode_sequences(sequences.encode_ids(documents, vocab, "doc_id"), vocab, "doc_id")


def encode_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = turns(spark, sf_dir)
    label = splitting.split_label(said.select("conv_id").distinct(), "conv_id")
    marked = said.withColumn("split", label)
    vocab = sequences.build_vocab(
        said.select(chats.DEFAULT_TEMPLATE.turn(F.col("role"), F.col("text")).alias("text"))
    )
    encoded = sequences.encode_conversations(marked, vocab, "split")
    return encoded.select("conv_id", "split", _joined("input_ids"), _joined("attention_mask"), _joined("labels"))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = _turns(spark, sf_dir).filter(F.col("role") == "user")
    return user.select("conv_id", "turn", F.col("text").alias("prompt"))


def prompt_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.prompt_grid(_prompts(spark, sf_dir))


def extract_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chats.render_chat(turns(spark, sf_dir))
    return rendered.select("conv_id", chats.extract_reply(F.col("chat")).alias("reply"))


def compare_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next reply stands for one variant, the reply after it for the other."""
    after = {"base": 1, "tuned": 3}
    answered = F.array(
        *[F.struct(F.lit(v).alias("variant"), (F.col("answer") - d).alias("turn")) for v, d in after.items()]
    )
    replies = _turns(spark, sf_dir).filter(F.col("role") == "assistant")
    responses = replies.select("conv_id", F.col("turn").alias("answer"), F.col("text").alias("response"))
    responses = responses.select("conv_id", "response", F.inline(answered))
    return chats.compare_responses(_prompts(spark, sf_dir), responses, ["conv_id", "turn"])


def style_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.style_delta(_turns(spark, sf_dir), "role", "user", "assistant")


def style_significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return significance.style_significance(_turns(spark, sf_dir), "role", "user", "assistant", turn_id)


def usable_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many e-mails are usable in each language, and why were the others not?"""
    accepted = F.col("status") == "ok"
    judged = _model(spark, sf_dir).with_language(_judged(spark, sf_dir), "clean", only=accepted)
    return (
        judged.withColumn("language", F.when(accepted, language.map_language(F.col("lang_detected"))))
        .groupBy("status", "language")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").cast("long").alias("total_words"))
        .orderBy("status", F.desc("n"), "language")
    )


QUERIES: dict[str, Query] = {
    "usable_emails": usable_emails,
    "mbox_scan": mbox_scan,
    "mbox_discover": mbox_discover,
    "jsonl_roundtrip": jsonl_roundtrip,
    "write_by_split": write_by_split,
    "mime_parts": mime_parts,
    "corpus_build": corpus_build,
    "corpus_read": corpus_read,
    "corpus_update": corpus_update,
    "examples_any_shape": examples_any_shape,
    "header_projection": header_projection,
    "drop_attachments": drop_attachments,
    "choose_body": choose_body,
    "decode_utf8": decode_utf8,
    "html_to_text": html_text,
    "cut_signature": _rule(cleaning.cut_signature),
    "drop_quoted": _rule(cleaning.drop_quoted),
    "stop_delimiter": _rule(cleaning.stop_delimiter),
    "stop_reply_header": _rule(cleaning.stop_reply_header),
    "drop_artifacts": _rule(cleaning.drop_artifacts),
    "drop_long_lines": _rule(cleaning.drop_long_lines, "documents", "text"),
    "drop_phone_lines": _rule(cleaning.drop_phone_lines),
    "normalize_whitespace": _rule(cleaning.normalize_whitespace),
    "clean_text": _rule(cleaning.clean_text),
    "learned_sign_offs": learned_sign_offs,
    "reject_reasons": reject_reasons,
    "min_words": min_words,
    "head_per_source": head_per_source,
    "head_per_source_large": head_per_source_large,
    "word_count": words_per_text,
    "lang_profile": lang_profile,
    "detect_language": detect_language,
    "map_language": map_language,
    "language_indicators": language_indicators,
    "user_prompt": user_prompt,
    "build_examples": build_examples,
    "assistant_texts": assistant_texts,
    "nested_assistant_texts": nested_assistant_texts,
    "ellipsize": cut_for_display,
    "processing_stats": processing_stats,
    "stream_counters": stream_counters,
    "language_distribution": language_distribution,
    "split_stats": split_stats,
    "split_language_stats": split_language_stats,
    "split_sizes": split_sizes,
    "length_stats": length_stats,
    "formality_counts": formality_counts,
    "formality_label": formality_label,
    "punctuation_stats": punctuation_stats,
    "text_counts": text_counts,
    "style_report": style_report,
    "full_style_report": full_style_report,
    "style_report_by_source": style_report_by_source,
    "top_openings": top_openings,
    "top_closings": top_closings,
    "top_words": top_words,
    "merged_top_words": merged_top_words,
    "length_quantiles": length_quantiles,
    "sample_texts": sample_texts,
    "seeded_shuffle": seeded_shuffle,
    "train_val_split": train_val_split,
    "grouped_split": grouped_split,
    "render_chat": render_chat,
    "render_chat_by_role": render_chat_by_role,
    "build_vocab": build_vocab,
    "encode_sequences": encode_sequences,
    "decode_sequences": decode_sequences,
    "encode_splits": encode_splits,
    "training_budget": training_budget,
    "prompt_grid": prompt_grid,
    "extract_reply": extract_reply,
    "compare_responses": compare_responses,
    "style_delta": style_delta,
    "style_significance": style_significance,
}
