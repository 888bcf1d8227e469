"""Spark schemas of the entities."""

from __future__ import annotations

GLOSSES = "array<struct<text:string,examples:array<struct<text:string,translation:string>>>>"
EXAMPLES = "array<struct<sentence:string,translation:string>>"
FALSE_FRIENDS = "array<struct<language:string,similar_word:string,similarity_score:double,actual_meaning:string>>"

#: Column and type of a word as a source gives it; ``_ord`` is its place in arrival order.
WORD = {
    "_ord": "bigint",
    "text": "string",
    "language": "string",
    "normalized": "string",
    "part_of_speech": "string",
    "frequency": "string",
    "translations": "map<string,string>",
    "topics": "array<string>",
    "glosses": GLOSSES,
    "examples": EXAMPLES,
    "false_friends": FALSE_FRIENDS,
    "sources": "array<string>",
}
#: Places of one source are below this power of two.
ORDER_BITS = 56
WORD_DDL = ", ".join(f"{name} {kind}" for name, kind in WORD.items())

STATS = "struct<seen_count:bigint,correct_count:bigint,error_count:bigint,last_seen_at:timestamp_ntz>"
PROGRESS_DDL = f"user_id string, word_id string, seen_count bigint, correct_count bigint, error_count bigint, last_seen_at timestamp_ntz, is_useless boolean, exercise_stats map<string,{STATS}>"
ATTEMPT_DDL = "user_id string, word_id string, exercise_type string, correct boolean, when timestamp_ntz, _ord bigint"

# Fixed values of the enumerations.
FREQUENCIES = ("high", "medium", "low")
EXERCISE_TYPES = ("wordle", "diacritic_typing", "pair_matching", "sentence_reconstruction", "conversational_tutor")
HINT_LEVELS = ("off", "show_unaccented", "show_all")
LETTER_STATES = ("unused", "wrong", "misplaced", "correct")
