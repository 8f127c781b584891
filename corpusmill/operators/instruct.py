"""Instruction data: passages, pairs, gates, chat rows and loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from corpusmill.functions import text as T
from corpusmill.operators.similar import GRAM, similar_pairs, too_similar  # noqa: F401

PAIRS = StructType([StructField("pairs", ArrayType(StructType([StructField("question", StringType()), StructField("answer", StringType())])))])
SCORES = StructType([StructField("scores", ArrayType(StructType([StructField("i", IntegerType()), StructField("score", IntegerType())])))])


def salvaged(text: Column, schema: StructType) -> Column:
    """A JSON object of ``schema``: the text itself, else from its first '{' to its last '}', else null."""
    field = schema.fieldNames()[0]
    begin = F.locate("{", text)
    end = F.length(text) - F.locate("}", F.reverse(text)) + 1
    inner = F.when((begin > 0) & (F.locate("}", text) > 0) & (end > begin), F.substring(text, begin, end - begin + 1))
    whole, part = F.from_json(text, schema), F.from_json(inner, schema)
    return F.when(whole[field].isNotNull(), whole).when(part[field].isNotNull(), part)


def role(messages: Column, name: str) -> Column:
    """The content of the last message of a role; null if there is none."""
    return F.get(F.transform(F.filter(F.reverse(messages), lambda m: m["role"] == name), lambda m: m["content"]), F.lit(0))


def grounding(answer: Column, passage: Column) -> Column:
    """The share of the answer's distinct words that the passage holds; null without words."""
    return T.let(F.array_distinct(T.words(answer)), lambda a: F.try_divide(F.size(F.array_intersect(a, T.words(passage))).cast("double"), F.size(a)))


def gram_vector(text: Column) -> Column:
    """Buckets of a normalized text's runs of four characters, by the first three hex digits of their md5."""
    t = T.normalized(text)

    def of(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(x) - 3)
        return F.when(F.length(x) >= 4, F.transform(starts, lambda i: F.conv(F.substring(F.md5(F.substring(x, i, F.lit(4))), 1, 3), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))

    return T.let(t, of)


def drop_similar(df: DataFrame, key: str, text: str, cosine: float = 0.95) -> DataFrame:
    """``df`` without the rows that are too similar to an earlier row that stays; a row without a key stays only if its text has no grams."""
    gone = too_similar(df, key, text, cosine).select(F.col("id").alias(key))
    return df.filter(F.col(key).isNotNull() | (F.length(T.normalized(F.col(text))) < GRAM)).join(gone, key, "left_anti").select(*df.columns)


def masked(prompt: Column, answer: Column, size: int, pad: str = "<pad>") -> tuple[Column, Column]:
    """Tokens padded to ``size`` and their loss mask: 1 on the answer, 0 on prompt and padding."""
    n = F.size(prompt) + F.size(answer)
    fill = F.greatest(F.lit(0), F.lit(size) - n)
    ids = F.concat(prompt, answer, F.array_repeat(F.lit(pad), fill))
    mask = F.concat(F.array_repeat(F.lit(0), F.size(prompt)), F.array_repeat(F.lit(1), F.size(answer)), F.array_repeat(F.lit(0), fill))
    return ids, mask
