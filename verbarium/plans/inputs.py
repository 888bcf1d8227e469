"""Inputs of the operators, derived from the driver's tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import characters, word_id
from ..operators.guessing import prompts
from ..operators.progress import progress
from ..sources.schemas import EXERCISE_TYPES, WORD_DDL

#: Places of a document's words are below this.
PLACES = 1_000_000
#: Characters by which words of one length are told apart before they are sorted.
BEGIN = 3
#: The five event types stand in for the exercise types, in this order.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, language, source, _ord) of every run of letters of ``documents``."""
    words = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", "source", F.posexplode(words).alias("pos", "text"))
    return rows.select("text", F.col("lang").alias("language"), "source", (F.col("doc_id") * PLACES + F.col("pos")).alias("_ord"))


def token_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens as words: a frequency tier by length, a translation, topics with their source."""
    size = F.length("text")
    tier = F.when(size <= 3, "high").when(size <= 6, "medium").when(size <= 9, "low")
    fields = {
        "_ord": F.col("_ord"),
        "text": F.col("text"),
        "language": F.col("language"),
        "normalized": F.lit(""),
        "part_of_speech": F.when(size % 2 == 0, "noun").otherwise(""),
        "frequency": tier,
        "translations": F.create_map(F.col("source"), F.reverse("text")),
        "topics": F.array("source", F.concat(F.lit("length-"), size.cast("string"))),
        "sources": F.array(F.lit("documents")),
    }
    df = tokens(spark, sf_dir)
    schema = [c.split(" ", 1) for c in WORD_DDL.split(", ")]
    return df.select(*[fields.get(n, F.array() if t.startswith("array") else F.lit(None)).cast(t).alias(n) for n, t in schema])


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (text, language) of the tokens with their number of uses."""
    return tokens(spark, sf_dir).groupBy("text", "language").agg(F.count("*").alias("uses"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts from ``events``."""
    return attempts_of(read(spark, sf_dir, "events"))


def attempts_of(events: DataFrame) -> DataFrame:
    """Attempts: the event type gives the exercise, the event id one of 97 words."""
    kinds = F.array(*[F.lit(t) for t in EVENT_TYPES])
    types = F.array(*[F.lit(t) for t in EXERCISE_TYPES])
    kind = F.array_position(kinds, F.col("event_type"))
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        word_id(F.concat(F.lit("w"), (F.col("event_id") % 97).cast("string")), F.lit("en")).alias("word_id"),
        F.when(kind > 0, F.get(types, (kind - 1).cast("int"))).alias("exercise_type"),
        (F.coalesce(F.col("value"), F.lit(0.0)) >= 50).alias("correct"),
        F.col("ts").cast("timestamp_ntz").alias("when"),
        F.col("event_id").alias("_ord"),
    )


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word for each part, with a frequency tier by its size."""
    size = F.col("p_size")
    tier = F.when(size <= 10, "high").when(size <= 25, "medium").when(size <= 40, "low")
    words = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("_ord"), F.concat(F.lit("w"), F.col("p_partkey").cast("string")).alias("text"), F.lit("en").alias("language"), tier.alias("frequency"))
    return words.withColumn("id", word_id(F.col("text"), F.col("language")))


def one_learner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress of all attempts as those of one learner; words of even last events are flagged."""
    rows = attempts(spark, sf_dir).withColumn("user_id", F.lit("all"))
    flags = rows.groupBy("user_id", "word_id").agg(F.max("_ord").alias("_last")).where("_last % 10 = 0")
    return progress(rows, flags)


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guessing session for each order: the customer's nation is hidden, the suppliers' are guessed in line order."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_key"), F.col("n_name").alias("_name"))
    orders = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    targets = orders.join(nation, F.col("c_nationkey") == F.col("_key")).select(F.col("o_orderkey").alias("session"), F.col("_name").alias("text"), F.lit("en").alias("language"))
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    place = F.col("l_linenumber") * 10**13 + F.col("l_partkey") * 10**6 + F.col("l_suppkey")
    tried = lines.join(nation, F.col("s_nationkey") == F.col("_key")).select(F.col("l_orderkey").alias("session"), place.alias("seq"), F.col("_name").alias("guess"))
    return prompts(targets, 3).join(tried.distinct(), "session")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct (text, language) with the next one of its language and length as ``guess``."""
    words = tokens(spark, sf_dir).select("text", "language").distinct().withColumns({"_size": F.length("text"), "_begin": F.substring("text", 1, BEGIN)})
    # A few words at a time: those of one beginning, the last of which is followed by the first of the next beginning.
    own = W.partitionBy("language", "_size", "_begin").orderBy("text")
    firsts = words.groupBy("language", "_size", "_begin").agg(F.min("text").alias("_first"))
    after = F.lead("_first").over(W.partitionBy("language", "_size").orderBy("_begin"))
    following = firsts.select(F.col("language").alias("_l"), F.col("_size").alias("_s"), F.col("_begin").alias("_b"), after.alias("_after"))
    same = F.col("language").eqNullSafe(F.col("_l")) & (F.col("_size") == F.col("_s")) & (F.col("_begin") == F.col("_b"))
    paired = words.withColumn("guess", F.lead("text").over(own)).join(following, same)
    return paired.select("text", "language", F.coalesce("guess", "_after").alias("guess")).where("guess is not null")


def keystrokes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typing sessions over ``neighbours``: the guess is typed, then the word itself."""
    rows = neighbours(spark, sf_dir).withColumn("hint_level", F.when(F.length("text") % 2 == 0, "off").otherwise("show_unaccented"))
    typed = F.posexplode(characters(F.concat("guess", "text"))).alias("seq", "keystroke")
    return rows.select(F.concat_ws("/", "language", "text").alias("session"), "text", "language", "hint_level", typed)


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching rounds: the parts of one size, each translated by its type."""
    part = read(spark, sf_dir, "part")
    return part.select(F.col("p_size").alias("round"), F.col("p_partkey").alias("_ord"), F.col("p_name").alias("text"), F.lit("en").alias("language"), F.create_map(F.lit("fr"), F.reverse("p_type")).alias("translations"))


def taps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tap for each line item: its part's name and its part's own translation."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("round"), F.col("p_name").alias("left"), F.reverse("p_type").alias("right"))
    return read(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "round", "left", "right")


def tutor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tutor turns: assistants are tutors, system turns go, corrections follow the length of the text."""
    n = F.length("text") % 3
    correction = F.when(n == 0, " ").when(n == 1, F.col("text"))
    turns = read(spark, sf_dir, "conversations").where("role <> 'system'")
    return turns.select(F.col("conv_id").alias("session"), "turn", F.when(F.col("role") == "assistant", "tutor").otherwise(F.col("role")).alias("role"), F.col("text").alias("content"), correction.alias("correction"))


def scored_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of a user's exercise from the attempts; correct ones have no word result."""
    rows = attempts(spark, sf_dir)
    return rows.select(F.concat_ws("/", "user_id", "exercise_type").alias("session"), "exercise_type", "correct", F.when(~F.col("correct"), F.col("word_id")).alias("word_id"), F.col("when").alias("at"), F.lit(None).cast("timestamp_ntz").alias("started_at"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user record for each order, of its customer."""
    orders = read(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").cast("string").alias("id"), F.concat("o_orderpriority", F.lit("@example.org")).alias("email"), F.col("o_orderstatus").alias("name"), F.col("o_orderkey").alias("_ord"))
