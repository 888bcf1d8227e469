"""The engine's queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.languages import with_language
from ..functions.text import accented_chars, has_accent, normalize, normalize_exact, word_id
from ..inference.operators import apply, offline, tutor_open, tutor_reply
from ..operators import guessing, matching, sessions, typing
from ..operators.progress import attempts_of_results, counted, hash_uniform, progress, progress_by_exercise, progress_totals, select_words, stored_progress, totals_of, weighted_pool
from ..operators.merge_state import MergedVocabulary
from ..operators.practised import WordNumbers, daily_bitmaps, stored_practice, words_practised
from ..operators.selection import select_for_learners
from ..operators.words import derive, merge_words, union_sources, word_filter
from ..sources.words import dictionary_lines_to_words, read_csv_words, read_dictionary_words, static_words
from ..storage import scratch_path
from ..streaming.live_rounds import live_guesses, live_keystrokes, typed_sessions
from ..streaming.progress_stream import late_attempts, latest, live_sessions, stream_progress
from . import inputs

NOW = datetime(2024, 3, 1)
SEED, DRAWS = 11, 25
#: Words for each of all learners.
EACH = 5
#: Buckets of the tables that the queries keep; their data are small.
STEP_BUCKETS = 8
#: The pause that ends a practice session, and how late an attempt may be, in the queries of streams.
SESSION_GAP, LATENESS = "12 hours", "1 day"


def _joined(column: Column | str) -> Column:
    return F.array_join(column, "|", "")


def accent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, accented words and distinct ids of each language."""
    text, words = F.col("text"), inputs.tokens(spark, sf_dir)
    # Uses of equal tokens are counted first, so that each is folded once.
    uses = words.groupBy("text", "language").agg(F.count("*").alias("n"))
    return uses.groupBy("language").agg(F.sum("n").alias("words"), F.sum(F.when(has_accent(text), F.col("n")).otherwise(0)).alias("accented"), F.count_distinct(word_id(text, F.col("language"))).alias("ids"))


def normalize_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, language = F.col("text"), F.col("language")
    return inputs.lexicon(spark, sf_dir).select("text", "language", "uses", normalize(text).alias("plain"), normalize(text, language).alias("normalized"), has_accent(text).alias("has_accent"), F.length("text").alias("length"))


def normalize_exact_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lexicon(spark, sf_dir).select("text", "language", normalize_exact(F.col("text"), F.col("language")).alias("normalized"))


def accented_chars_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = inputs.lexicon(spark, sf_dir).select("language", "uses", F.explode(accented_chars(F.col("text"))).alias("letter"))
    return chars.groupBy("language", "letter").agg(F.sum("uses").alias("n"))


def word_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lexicon(spark, sf_dir).select("text", "language", word_id(F.col("text"), F.col("language")).alias("id"))


def language_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.read(spark, sf_dir, "documents").select("doc_id", F.upper("lang").alias("code"))
    info = with_language(docs, "code")
    return info.select("doc_id", "code", "language_info.name", "language_info.native_name", _joined("language_info.accent_keys").alias("accent_keys"))


def filtered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = word_filter(has_accent=True, has_translation="src3", min_length=4, max_length=12, topics=["src3", "length-5", "length-8"], languages=["fr", "de"])
    return derive(inputs.token_words(spark, sf_dir)).where(wanted).select("_ord", "text", "language", "id", "normalized")


def _tokens_with_own_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("_ord") % 3 == 0, F.concat(F.lit("="), "text")).otherwise("")
    return inputs.token_words(spark, sf_dir).withColumn("normalized", own)


def _merged_columns(merged: DataFrame) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("translations")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return merged.select("id", "_ord", "text", "language", "normalized", "part_of_speech", "frequency", _joined(pairs).alias("translations"), _joined("topics").alias("topics"), _joined("sources").alias("sources"), F.size("glosses").alias("n_glosses"))


def dedup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens merged by id; every third one comes with a normalized text of its own."""
    return _merged_columns(merge_words(_tokens_with_own_text(spark, sf_dir)))


def merged_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_words`` from a stored vocabulary that got the documents in three parts, the last ones first, one twice."""
    words = _tokens_with_own_text(spark, sf_dir)
    vocabulary = MergedVocabulary(scratch_path(spark, "vocabulary"))
    third = F.floor(F.col("_ord") / inputs.PLACES) % 3
    for batch, part in ((1, 2), (2, 0), (2, 0), (3, 1)):
        vocabulary.add(words.where(third == part), batch)
    return _merged_columns(vocabulary.read(spark))


def progress_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals from stored counters that got the events in three batches, one twice."""
    rows, table = inputs.attempts(spark, sf_dir), stored_progress(scratch_path(spark, "progress"), STEP_BUCKETS)
    for batch, part in ((1, 1), (2, 0), (2, 0), (3, 2)):
        table.apply(counted(rows.where(F.col("_ord") % 3 == part)), batch)
    return totals_of(table.read(spark))


def users_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from a stored table that got the orders in three batches, one twice."""
    rows, table = inputs.users(spark, sf_dir), sessions.stored_users(scratch_path(spark, "users"), STEP_BUCKETS)
    for batch, part in ((1, 2), (2, 1), (2, 1), (3, 0)):
        table.apply(sessions.user_records(rows.where(F.col("_ord") % 3 == part)), batch)
    return sessions.users_of(table.read(spark))


def csv_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a CSV vocabulary and read back."""
    part = inputs.read(spark, sf_dir, "part")
    rows = part.select(
        F.concat(F.lit(" "), "p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("text"),
        F.lit(" EN ").alias("language"),
        F.when(F.col("p_size") % 2 == 0, F.lower("p_type")).alias("part_of_speech"),
        F.when(F.col("p_size") < 15, " High").when(F.col("p_size") < 30, "LOW").otherwise("rare").alias("frequency"),
        F.concat("p_brand", F.lit(", ,"), "p_type").alias("topics"),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("\""), "p_type", F.lit("\", x"))).alias("secondary_topics"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), F.reverse("p_name"))).alias("translation_fr"),
        F.when(F.col("p_size") % 7 == 0, F.concat("p_name", F.lit(",\n"), "p_brand")).alias("example_sentence"),
        F.when(F.col("p_size") % 4 == 0, F.lit("FR")).alias("false_friend_language"),
        F.col("p_brand").alias("false_friend_word"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5 ")).alias("false_friend_similarity"),
    )
    path = scratch_path(spark, "csv")
    rows.write.csv(path, header=True, quote='"', escape='"')
    words = derive(read_csv_words(spark, path))
    example, friend = F.get("examples", 0), F.get("false_friends", 0)
    return words.select("text", "language", "id", "part_of_speech", "frequency", F.try_element_at("translations", F.lit("fr")).alias("fr"), _joined("topics").alias("topics"), example["sentence"].alias("sentence"), friend["language"].alias("friend_language"), friend["similarity_score"].alias("friend_score"), _joined("sources").alias("sources"))


def wiktionary_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as dictionary lines and read back."""
    part = inputs.read(spark, sf_dir, "part")
    example = F.struct(F.col("p_brand").alias("text"), F.col("p_name").alias("english"))
    silent = F.struct(F.lit("").alias("text"), F.lit("none").alias("english"))
    sense = lambda gloss: F.struct(F.array(gloss, F.lit("second")).alias("glosses"), F.array(example, silent).alias("examples"))
    pos = F.when(F.col("p_size") % 4 == 0, "Noun").when(F.col("p_size") % 4 == 1, "letter").when(F.col("p_size") % 4 == 2, "verb")
    forms = F.when(F.col("p_size") % 6 == 0, F.array(F.create_map(F.lit("word"), F.col("p_name"))))
    record = F.struct(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("word"), pos.alias("pos"), F.array(sense(F.col("p_type")), sense(F.lit(""))).alias("senses"), forms.alias("form_of"))
    line = F.when(F.col("p_partkey") % 50 == 7, "no json").when(F.col("p_partkey") % 50 == 8, "  ").otherwise(F.to_json(record))
    path = scratch_path(spark, "jsonl")
    part.select(line.alias("value")).write.text(path)
    words = derive(read_dictionary_words(spark, path, "en"))
    gloss = F.get("glosses", 0)
    return words.select("text", "id", "part_of_speech", F.size("glosses").alias("n_glosses"), gloss["text"].alias("gloss"), F.size(gloss["examples"]).alias("n_examples"), F.get(gloss["examples"], 0)["translation"].alias("english"))


def static_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, a table of 25 rows by definition, as an in-memory list."""
    names = [r["n_name"] for r in inputs.read(spark, sf_dir, "nation").select("n_name").collect()]
    words = derive(static_words(spark, [{"text": n, "language": "EN", "extra": "x"} for n in names]))
    return words.select("text", "language", "id", "normalized", "length", _joined("sources").alias("sources"))


def progress_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress_totals(inputs.attempts(spark, sf_dir))


def progress_by_exercise_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress_by_exercise(inputs.attempts(spark, sf_dir))


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_pool(inputs.pool(spark, sf_dir), inputs.one_learner(spark, sf_dir), NOW)


def word_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir).select("id", "text", "frequency", F.round("weight", 9).alias("weight"))


def selected_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_words(_weighted(spark, sf_dir), DRAWS, hash_uniform(SEED, "id", "_ord")).select("id", "text", F.round("weight", 9).alias("weight"))


def wordle_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.neighbours(spark, sf_dir).withColumn("letters", guessing.evaluate(F.col("guess"), F.col("text")))
    return rows.select("language", "text", "guess", _joined(F.transform("letters", lambda x: F.concat(x["letter"], F.lit(":"), x["state"]))).alias("letters"))


def wordle_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guessing.play(inputs.guesses(spark, sf_dir)).select("session", "seq", "guess", "status", "correct", "attempt", "ends")


def wordle_keyboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guessing.keyboard(guessing.play(inputs.guesses(spark, sf_dir)))


def diacritic_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = inputs.lexicon(spark, sf_dir).select("text", "language", F.explode(F.array(*[F.lit(h) for h in ("off", "show_unaccented", "show_all")])).alias("hint_level"))
    return words.select("text", "language", "hint_level", F.array_join(typing.initial_display(F.col("text"), F.col("hint_level")), "").alias("display"))


def diacritic_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    played = typing.play(inputs.keystrokes(spark, sf_dir))
    return played.withColumns({"display": F.array_join("display", ""), "disabled_keys": F.array_join("disabled_keys", "")})


def pair_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = matching.score_taps(inputs.taps(spark, sf_dir), matching.pairs(inputs.rounds(spark, sf_dir), "fr"))
    return scored.groupBy("round", "left", "right", "word_id", "correct").agg(F.count("*").alias("taps"))


def sentence_portions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    portions = matching.merge_short_portions(matching.split_sentence(text))
    return inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", _joined(portions).alias("portions"), F.size(portions).alias("n_portions"))


def tutor_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.tutor_turns(inputs.tutor_table(spark, sf_dir))


def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_summary(inputs.scored_rounds(spark, sf_dir)).withColumn("words_practiced", _joined("words_practiced"))


def user_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.upsert_users(inputs.users(spark, sf_dir))


def progress_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals of a stream of attempts over ``events``, from its stored updates."""
    out, path = scratch_path(spark, "stream"), f"{sf_dir}/events.parquet"
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")  # a pattern, as a stream takes no single file

    def sink(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/updates/batch={batch}")

    query = stream_progress(inputs.attempts_of(events), sink, f"{out}/checkpoint")
    query.awaitTermination()
    return latest(spark.read.parquet(f"{out}/updates"), "user_id", "word_id")


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.read(spark, sf_dir, "nation").select(F.col("n_name").alias("topic"), F.lit("fr").alias("language"))


def generated_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit("fr").alias("source_language"), F.lit("en").alias("target_language"))
    return apply(rows, "translation", offline).select("conv_id", "turn", "output.translated_text", "valid")


def generated_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply(_topics(spark, sf_dir), "conversation", offline)
    return out.select("topic", F.size("output.turns").alias("n_turns"), _joined(F.transform("output.turns", lambda t: t["role"])).alias("roles"), "valid")


def generated_tutoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.read(spark, sf_dir, "conversations").where("role = 'user'")
    rows = turns.select("conv_id", "turn", F.lit("travel").alias("topic"), F.lit("fr").alias("language"), F.col("text").alias("user_message"))
    return apply(rows, "tutor", offline).select("conv_id", "turn", "output.conversation.content", F.size("output.correction.errors").alias("n_errors"), "valid")


def generated_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _topics(spark, sf_dir).withColumn("difficulty_level", F.col("topic")).withColumn("num_topics", F.lit(3))
    return apply(rows, "topics", offline).select("topic", _joined("output.topics").alias("topics"), "valid")


def generated_portions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit("fr").alias("language"))
    return apply(rows, "splitter", offline).select("conv_id", "turn", _joined("output.portions").alias("portions"), "valid")


def generated_greetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply(_topics(spark, sf_dir), "greeting", offline).select("topic", "output.greeting", "valid")


def generated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _topics(spark, sf_dir).withColumn("require_accents", F.col("topic").endswith("1"))
    return apply(rows, "word_generator", offline).select("topic", _joined(F.transform("output.words", lambda w: w["text"])).alias("words"), "valid")


def matching_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both columns of every matching round, the right one shuffled."""
    shown = matching.columns_shown(matching.pairs(inputs.rounds(spark, sf_dir), "fr"), SEED)
    return shown.select("round", _joined("left_words").alias("left_words"), _joined("right_words").alias("right_words"))


def sentence_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences cut and shuffled, and whether the shuffled order and the expected one would be right."""
    said = inputs.read(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("sentence"), F.lit(None).cast("array<string>").alias("portions"))
    rounds = matching.sentence_rounds(said, SEED)
    right = lambda c: matching.score_order(F.col(c), F.col("expected"))
    return rounds.select("conv_id", "turn", _joined("expected").alias("expected"), _joined("shuffled").alias("shuffled"), right("shuffled").alias("shuffled_right"), right("expected").alias("expected_right"))


def union_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, then regions, then nations again, as sources one after the other, merged."""
    source = lambda table, name, code: static_words(spark, [{"text": r[0].title(), "language": code} for r in sorted(inputs.read(spark, sf_dir, table).select(name).collect())])
    nations, regions = source("nation", "n_name", "en"), source("region", "r_name", "en")
    merged = merge_words(union_sources(nations, regions, nations))
    return merged.select("id", "text", "normalized", (F.col("_ord") >= 1 << 56).alias("from_region"))


def offered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guessing.offered(inputs.lexicon(spark, sf_dir)).select("text", "language", "uses")


def typing_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a typing round shows at first, with the words' glosses."""
    gloss = F.array(F.struct(F.concat(F.lit("like "), "text").alias("text"), F.array().cast("array<struct<text:string,translation:string>>").alias("examples")))
    words = inputs.lexicon(spark, sf_dir).withColumns({"glosses": gloss, "hint_level": F.when(F.length("text") % 2 == 0, "off").otherwise("show_unaccented")})
    return typing.prompts(words).select("text", "language", F.array_join("display", "").alias("display"), _joined("gloss_texts").alias("gloss_texts"))


def accented_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines of the lexicon, of which those with an accent are kept."""
    lines = inputs.lexicon(spark, sf_dir).select(F.to_json(F.struct(F.col("text").alias("word"), F.lit("noun").alias("pos"))).alias("line"), F.lit(0).cast("long").alias("_ord"))
    words = dictionary_lines_to_words(lines, "xx", require_accent=True)
    return words.groupBy("text", "part_of_speech").agg(F.count("*").alias("n"))


def played_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guessing sessions as attempts of their customers, counted."""
    results = guessing.word_results(guessing.play(inputs.guesses(spark, sf_dir)))
    played = inputs.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("session"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("when"), F.col("o_orderkey").alias("_ord"))
    return progress_by_exercise(attempts_of_results(results, played, "wordle"))


def typed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typing sessions as attempts of a learner of each language, counted."""
    rows = inputs.keystrokes(spark, sf_dir)
    played = rows.select("session", F.col("language").alias("user_id")).distinct().withColumns({"when": F.lit(NOW).cast("timestamp_ntz"), "_ord": F.lit(0)})
    return progress_by_exercise(attempts_of_results(typing.word_results(typing.play(rows)), played, "diacritic_typing"))


def matched_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taps of matching rounds as attempts of a learner each round, counted."""
    scored = matching.score_taps(inputs.taps(spark, sf_dir), matching.pairs(inputs.rounds(spark, sf_dir), "fr"))
    played = inputs.rounds(spark, sf_dir).select(F.col("round").alias("session")).distinct().withColumns({"user_id": F.concat(F.lit("u"), F.col("session").cast("string")), "when": F.lit(NOW).cast("timestamp_ntz"), "_ord": F.lit(0)})
    return progress_by_exercise(attempts_of_results(matching.word_results(scored), played, "pair_matching"))


def tutor_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tutor sessions opened with a greeting, and the answer to the first user turn of each conversation."""
    first = inputs.read(spark, sf_dir, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("user_message"))
    opened = tutor_open(first.select(F.col("conv_id").alias("session"), F.lit("travel").alias("topic"), F.lit("fr").alias("language"), "user_message"), offline)
    replied = tutor_reply(opened, offline)
    message = lambda m: F.concat(m["role"], F.lit(": "), m["content"])
    return replied.select("session", _joined(F.transform("history", message)).alias("history"), "correct", "feedback")


def _as_stream(rows: DataFrame, live: Callable[[DataFrame], DataFrame], name: str, ended: Callable[[StreamingQuery], None] = lambda _: None) -> DataFrame:
    """What ``live`` makes of ``rows`` as a stream: they come in the order of their ``part``, and the query is started anew from its checkpoint for each.

    ``ended`` gets the query after each part.
    """
    spark = rows.sparkSession
    home = scratch_path(spark, name)
    rows.write.partitionBy("part").parquet(f"{home}/all")
    parts = spark.read.parquet(f"{home}/all")
    sent = parts.drop("part")
    for part in (1, 2, 3):
        parts.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{home}/in")
        answers = live(spark.readStream.schema(sent.schema).parquet(f"{home}/in"))
        started = answers.writeStream.format("parquet").outputMode("append").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint")
        query = started.trigger(availableNow=True).start()
        query.awaitTermination()
        ended(query)
    return spark.read.parquet(f"{home}/out")


def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a stream of attempts in three parts of ten days: every tenth comes twice, every 23rd and the repetitions of the 30th a part later."""
    rows, late = inputs.attempts(spark, sf_dir), []
    day, again = F.dayofmonth("when"), F.col("_ord") % 10 == 0
    part = F.least(F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3) + F.when(F.col("_ord") % 23 == 0, 1).otherwise(0), F.lit(3))
    second = F.least(part + F.when(F.col("_ord") % 30 == 0, 1).otherwise(0), F.lit(3))
    sent = rows.withColumn("part", F.explode(F.when(again, F.array(part, second)).otherwise(F.array(part))))
    answers = _as_stream(sent, lambda df: live_sessions(df, SESSION_GAP, LATENESS), "sessions", lambda query: late.append(late_attempts(query)))
    start, end = (F.col(f"session_window.{side}").cast("timestamp_ntz").alias(f"session_{side}") for side in ("start", "end"))
    return answers.select("user_id", start, end, "attempts", "correct_attempts", F.lit(sum(late)).cast("long").alias("late_rows"))


def practised_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of each learner by week, and at all (week is null), from stored daily bitmaps of three batches."""
    rows, home = inputs.attempts(spark, sf_dir), scratch_path(spark, "practice")
    numbers, table = WordNumbers(home, STEP_BUCKETS), stored_practice(f"{home}/days", STEP_BUCKETS)
    for batch in range(3):
        step = rows.where(F.pmod(F.col("_ord"), F.lit(3)) == batch)
        numbers.add(step, batch)
        table.apply(daily_bitmaps(step, numbers.read(spark)), batch)
    days = table.read(spark).withColumn("week", F.trunc("day", "week"))
    weeks, total = words_practised(days, "user_id", "week"), words_practised(days, "user_id")
    return weeks.unionByName(total.withColumn("week", F.lit(None).cast("date")))


def _minutes(n: Column) -> Column:
    return F.timestamp_add("MINUTE", n, F.lit(NOW))


def live_wordle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guesses as a stream, a minute from line to line, in three parts; rounds without an end are left after 150 s."""
    rows = inputs.guesses(spark, sf_dir).select("session", "seq", "guess", "target_id", "target", "max_attempts", (F.col("seq") / 10**13).cast("int").alias("line"))
    part = F.least(F.ceil(F.col("line") / 2).cast("int"), F.lit(3))
    timed = rows.select("session", "seq", "guess", "target_id", "target", "max_attempts", _minutes(F.col("line")).alias("at"), part.alias("part"))
    answers = _as_stream(timed, lambda df: live_guesses(df, timedelta(seconds=150), timedelta(minutes=1)), "live-guesses")
    return answers.select("session", "seq", "guess", "status", "correct", "attempt", "ends", "feedback")


def live_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keystrokes as a stream, a minute from one to the next, in three parts; the sessions as they are at last."""
    rows = inputs.keystrokes(spark, sf_dir)
    part = F.when(F.col("seq") < 4, 1).when(F.col("seq") < 9, 2).otherwise(3)
    timed = rows.select("session", "seq", "keystroke", "text", "language", "hint_level", _minutes(F.col("seq")).alias("at"), part.alias("part"))
    answers = _as_stream(timed, live_keystrokes, "live-keystrokes")
    words = rows.where("seq = 0").select("session", "text", "language", "hint_level")
    return typed_sessions(answers, words).withColumns({"display": F.array_join("display", ""), "disabled_keys": F.array_join("disabled_keys", "")})


def learners_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words for every customer, whose attempts are the events of the same number."""
    learners = inputs.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    rows = inputs.attempts(spark, sf_dir)
    flags = rows.groupBy("user_id", "word_id").agg(F.max("_ord").alias("_last")).where("_last % 10 = 0")
    drawn = select_for_learners(inputs.pool(spark, sf_dir), progress(rows, flags), learners, EACH, NOW, SEED)
    return drawn.select("user_id", "rank", "id", "tier", F.round("weight", 9).alias("weight"))


QUERIES = {f.__name__: f for f in (accent_stats, normalize_tokens, normalize_exact_tokens, accented_chars_hist, word_ids, language_lookup, dedup_words, csv_vocabulary, wiktionary_vocabulary, static_vocabulary, word_weights, wordle_eval, wordle_session, wordle_keyboard, diacritic_display, diacritic_session, pair_matching, matching_columns, sentence_portions, sentence_rounds, union_vocabulary, offered_words, typing_prompts, accented_dictionary, played_progress, typed_progress, matched_progress, tutor_sessions, tutor_turns, session_summary, user_upsert, progress_stream, generated_translations, generated_conversations, generated_tutoring, generated_topics, generated_portions, generated_greetings, generated_words, live_wordle, live_typing, learners_words, merged_in_steps, progress_in_steps, users_in_steps, streamed_sessions, practised_in_steps)}
QUERIES |= {"word_filter": filtered_words, "progress_totals": progress_totals_query, "progress_by_exercise": progress_by_exercise_query, "select_words": selected_words}
