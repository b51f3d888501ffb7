"""Conversations: rendering, prompts, replies and side-by-side comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions.cleaning import cut_signature
from lettermill.functions.fixed_values import COMPARISON_PROMPTS
from lettermill.functions.text import strip, word_count
from lettermill.operators.style import style_totals, written
from lettermill.plans.levels import joined_in_levels

VARIANTS = ("base", "tuned")


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around every turn; ``{role}`` is replaced by the role.

    ``begin`` stands once before the first turn. ``roles`` gives single roles
    marks of their own: (role, open, close).
    """

    turn_open: str = "<|{role}|>\n"
    turn_close: str = "<|end|>\n"
    reply_role: str = "assistant"
    begin: str = ""
    roles: tuple[tuple[str, str, str], ...] = ()

    def turn(self, role: Column, content: Column) -> Column:
        """Text of one turn; a null role or content counts as empty."""
        role, content = F.coalesce(role, F.lit("")), F.coalesce(content, F.lit(""))
        before, name, after = self.turn_open.partition("{role}")
        text = F.concat(F.lit(before), role if name else F.lit(""), F.lit(after), content, F.lit(self.turn_close))
        for own, opening, closing in self.roles:
            text = F.when(role == own, F.concat(F.lit(opening), content, F.lit(closing))).otherwise(text)
        return text

    def reply_start(self) -> str:
        own = {role: opening for role, opening, _ in self.roles}
        return own.get(self.reply_role, self.turn_open.format(role=self.reply_role))

    def render(self, messages: Column, generation_prompt: bool = False) -> Column:
        """One string from an ordered ``messages`` array: a narrow projection."""
        turns = F.array_join(F.transform(messages, lambda m: self.turn(m["role"], m["content"])), "")
        return F.concat(F.lit(self.begin), turns, F.lit(self.reply_start() if generation_prompt else ""))


DEFAULT_TEMPLATE = ChatTemplate()


def nest_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turn rows to one row per conversation with an ordered ``messages`` array."""
    message = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("content")))
    return joined_in_levels(turns.withColumn("messages", message), [conv], "turn", "messages", F.flatten)


def render_chat(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, conv: str = "conv_id") -> DataFrame:
    """Chat text of every conversation, and the same text ready for a reply.

    Every turn is rendered by itself and texts are joined in levels, so a
    conversation of any length is one row with one reply mark at its end.
    """
    rendered = turns.withColumn("chat", template.turn(F.col("role"), F.col("text")))
    joined = joined_in_levels(rendered, [conv], "turn", "chat", lambda parts: F.array_join(parts, ""))
    chat = F.concat(F.lit(template.begin), "chat")
    return joined.select(conv, chat.alias("chat"), F.concat(chat, F.lit(template.reply_start())).alias("chat_for_reply"))


def extract_reply(response: Column) -> Column:
    """What follows the last lower-case ``assistant``, stripped; else the response as it is."""
    marked = response.contains("assistant")
    return F.when(marked, strip(F.substring_index(response, "assistant", -1))).otherwise(response)


def default_prompts(spark: SparkSession) -> DataFrame:
    """The prompts that variants are compared on where no others are given."""
    return spark.createDataFrame(list(enumerate(COMPARISON_PROMPTS)), "prompt_id int, prompt string")


def prompt_grid(
    prompts: DataFrame,
    prompt: str = "prompt",
    variants: tuple[str, ...] = VARIANTS,
    template: ChatTemplate = DEFAULT_TEMPLATE,
) -> DataFrame:
    """Every prompt for every variant, with the text to send."""
    request = F.concat(F.lit(template.begin), template.turn(F.lit("user"), F.col(prompt)), F.lit(template.reply_start()))
    return prompts.withColumn("request", request).withColumn(
        "variant", F.explode(F.array(*[F.lit(v) for v in variants]))
    )


def compare_responses(
    prompts: DataFrame, responses: DataFrame, keys: list[str], variants: tuple[str, str] = VARIANTS
) -> DataFrame:
    """Both responses beside each prompt; a missing one is NULL.

    Two responses of one variant to one prompt are an error: give each sample
    a key of its own. Pivoting on the prompt key needs one shuffle of the responses; the join
    reuses that partitioning.
    """
    sides = responses.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variant") == v, F.col("response"))).alias(f"{v}_response") for v in variants],
        *[F.count_if(F.col("variant") == v).alias(f"_{v}") for v in variants],
    )
    several = F.greatest(*[F.col(f"_{v}") for v in variants]) > 1
    problem = F.raise_error(F.lit("more than one response of a variant to one prompt")).cast("string")
    sides = sides.select(
        *keys, *[F.when(several, problem).otherwise(F.col(f"{v}_response")).alias(f"{v}_response") for v in variants]
    )
    return prompts.join(sides, keys, "left")


def style_delta(df: DataFrame, cohort: str, left: str, right: str, text: str = "text") -> DataFrame:
    """Style measures of two cohorts side by side, and right minus left.

    Numbers of words and phrases, punctuation, languages, sentences and their
    length, and how many texts close with a sign-off.
    """
    metrics = [
        "texts", "avg_words", "min_words", "max_words", "contractions", "formal", "casual",
        "exclamations", "questions", "avg_exclamations", "avg_questions",
        "dutch", "english", "dutch_percent", "english_percent",
    ]
    pair = df.filter(F.col(cohort).isin(left, right))
    long = style_totals(pair, cohort, text=text).select(
        F.col(cohort).alias("_cohort"),
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
            )
        ),
    )
    body = F.col(text)
    closing = written(pair, text).select(
        F.col(cohort).alias("_cohort"),
        F.regexp_count(body, F.lit("[.!?]+")).alias("sentences"),
        word_count(body).alias("words"),
        (cut_signature(body) != body).alias("signed"),
    ).groupBy("_cohort").agg(F.sum("sentences").alias("s"), F.sum("words").alias("w"), F.count_if("signed").alias("c"))
    more = {"sentences": F.col("s"), "avg_sentence_words": F.try_divide(F.col("w"), F.col("s")), "sign_offs": F.col("c")}
    long = long.unionByName(closing.select("_cohort", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in more.items()
    ]))))
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col("_cohort") == left, F.col("value"))).alias("left_value"),
        F.max(F.when(F.col("_cohort") == right, F.col("value"))).alias("right_value"),
    )
    return sides.withColumn("delta", F.col("right_value") - F.col("left_value"))
