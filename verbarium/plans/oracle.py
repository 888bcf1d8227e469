"""DuckDB SQL of the engine's queries, over the same tables."""

from __future__ import annotations

from ..functions.languages import LANGUAGES
from ..operators.selection import PER_WORD, ROOM, SPARE
from ..sources.schemas import EXERCISE_TYPES
from .inputs import EVENT_TYPES
from .queries import DRAWS, EACH, LATENESS, SEED, SESSION_GAP

TOKENS = r"""
d AS (SELECT doc_id, lang, source, regexp_extract_all(text, '\p{L}+') AS w FROM documents
), tok AS (SELECT unnest(w) AS text, lang AS language, source, doc_id * 1000000 + unnest(range(len(w))) AS _ord FROM d
), lex AS (SELECT text, language, count(*) AS uses FROM tok GROUP BY ALL
)"""


def folded(text: str) -> str:
    return f"lower(strip_accents({text}))"


def word_id(text: str, language: str) -> str:
    return f"substr(sha1(lower({language}) || '::' || {folded(text)}), 1, 16)"


def mapped(text: str) -> str:
    cases = ""
    for code, language in LANGUAGES.items():
        inner = text
        for letter, base in language.letter_map.items():
            inner = f"replace({inner}, '{letter}', '{base}')"
        cases += f" WHEN '{code}' THEN {inner}"
    return f"CASE language{cases} ELSE {text} END"


ACCENT = f"{folded('text')} <> lower(text)"
_LANGUAGES = ", ".join(f"('{c}', '{x.name}', '{x.native_name}', '{'|'.join(sorted(set(x.accented)))}')" for c, x in LANGUAGES.items())
_TYPES = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{x}'" for e, x in zip(EVENT_TYPES, EXERCISE_TYPES, strict=True)) + " END"
ATTEMPTS = f"""
a AS (SELECT user_id::VARCHAR AS user_id, {word_id("'w' || (event_id % 97)", "'en'")} AS word_id, {_TYPES} AS exercise_type,
  coalesce(value, 0) >= 50 AS correct, ts AS "when", event_id AS _ord FROM events)"""
COUNTERS = 'count(*) AS seen_count, count(*) FILTER (correct) AS correct_count, count(*) FILTER (NOT correct) AS error_count, arg_max("when", _ord) AS last_seen_at'
TOTALS = f"WITH {ATTEMPTS} SELECT user_id, word_id, {COUNTERS} FROM a GROUP BY ALL"

STREAMED_SESSIONS = f"""WITH {ATTEMPTS}
, p AS (SELECT *, least(CASE WHEN day("when") <= 10 THEN 1 WHEN day("when") <= 20 THEN 2 ELSE 3 END + (_ord % 23 = 0)::INT, 3) AS part FROM a)
, sent AS (SELECT * FROM p UNION ALL SELECT * REPLACE (least(part + (_ord % 30 = 0)::INT, 3) AS part) FROM p WHERE _ord % 10 = 0)
, marks AS (SELECT k.part, (SELECT max("when") FROM sent WHERE sent.part < k.part) - INTERVAL '{LATENESS}' AS mark FROM (VALUES (1), (2), (3), (4)) k(part))
, timed AS (SELECT sent.*, mark IS NOT NULL AND "when" <= mark AS late FROM sent JOIN marks USING (part))
, once AS (SELECT DISTINCT user_id, _ord, "when", correct FROM timed WHERE NOT late)
, begun AS (SELECT *, coalesce("when" - lag("when") OVER w > INTERVAL '{SESSION_GAP}', true)::INT AS new FROM once WINDOW w AS (PARTITION BY user_id ORDER BY "when", _ord))
, numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY "when", _ord) AS n FROM begun)
, sessions AS (SELECT user_id, min("when") AS session_start, max("when") + INTERVAL '{SESSION_GAP}' AS session_end, count(*) AS attempts, count(*) FILTER (correct) AS correct_attempts FROM numbered GROUP BY user_id, n)
SELECT *, (SELECT count(*) FROM timed WHERE late) AS late_rows FROM sessions WHERE session_end <= (SELECT mark FROM marks WHERE part = 4)"""

WEIGHTED = f"""
{ATTEMPTS}, r AS (SELECT word_id, {COUNTERS}, max(_ord) % 10 = 0 AS useless FROM a GROUP BY ALL
), p AS (
  SELECT p_partkey AS _ord, 'w' || p_partkey AS text, {word_id("'w' || p_partkey", "'en'")} AS id,
    CASE WHEN p_size <= 10 THEN 'high' WHEN p_size <= 25 THEN 'medium' WHEN p_size <= 40 THEN 'low' END AS frequency FROM part
), w AS (
  SELECT _ord, id, text, frequency, CASE WHEN coalesce(useless, false) THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE,
    CASE WHEN coalesce(seen_count, 0) = 0 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE + 3.0::DOUBLE * error_count END
    * CASE frequency WHEN 'high' THEN 1.2::DOUBLE WHEN 'medium' THEN 1.0::DOUBLE WHEN 'low' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END
    * CASE WHEN last_seen_at IS NULL THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - pow(0.5::DOUBLE, greatest(0.0::DOUBLE, date_diff('microsecond', last_seen_at, TIMESTAMP '2024-03-01') / 1e6::DOUBLE) / 3600.0::DOUBLE) END) END AS weight
  FROM p LEFT JOIN r ON p.id = r.word_id
)"""

def _weight(seen: str, errors: str, last: str, useless: str) -> str:
    """The selection weight of a word with ``frequency``, by the columns of its record."""
    return f"""CASE WHEN coalesce({useless}, false) THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, CASE WHEN coalesce({seen}, 0) = 0 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE + 3.0::DOUBLE * {errors} END
      * CASE frequency WHEN 'high' THEN 1.2::DOUBLE WHEN 'medium' THEN 1.0::DOUBLE WHEN 'low' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END
      * CASE WHEN {last} IS NULL THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - pow(0.5::DOUBLE, greatest(0.0::DOUBLE, date_diff('microsecond', {last}, TIMESTAMP '2024-03-01') / 1e6::DOUBLE) / 3600.0::DOUBLE) END) END"""


def _uniform(kind: str, *columns: str) -> str:
    return f"((('0x' || substr(sha1(concat_ws('|', '{SEED}|{kind}', {', '.join(columns)})), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"


_OWN_KEY = f"-ln({_uniform('own', 'user_id', 'tier', 'pos')}) / weight"
LEARNERS = f"""WITH {ATTEMPTS}, r AS (SELECT user_id, word_id, {COUNTERS}, max(_ord) % 10 = 0 AS useless FROM a GROUP BY ALL
), p AS (
  SELECT id, tier, frequency, row_number() OVER (PARTITION BY tier ORDER BY sha1(id || '|' || _ord)) - 1 AS pos FROM (
    SELECT *, coalesce(frequency, '') AS tier FROM (SELECT p_partkey AS _ord, {word_id("'w' || p_partkey", "'en'")} AS id,
      CASE WHEN p_size <= 10 THEN 'high' WHEN p_size <= 25 THEN 'medium' WHEN p_size <= 40 THEN 'low' END AS frequency FROM part))
), t AS (SELECT tier, count(*) AS size, {_weight('NULL', '0', 'NULL::TIMESTAMP', 'NULL')} AS weight FROM p GROUP BY tier, frequency
), l AS (SELECT DISTINCT c_custkey::VARCHAR AS user_id FROM customer
), seen AS (SELECT user_id, tier, pos, {_weight('seen_count', 'error_count', 'last_seen_at', 'useless')} AS weight FROM r JOIN l USING (user_id) JOIN p ON p.id = word_id
), o AS (SELECT l.user_id, t.*, coalesce(n, 0) AS n FROM l CROSS JOIN t LEFT JOIN (SELECT user_id, count(*) AS n FROM seen GROUP BY user_id) USING (user_id)
), j AS (SELECT *, unnest(range(1, {PER_WORD * EACH + SPARE + 1})) AS jump FROM o WHERE size >= {ROOM} * ({EACH} + n)
), arrivals AS (
  SELECT user_id, tier, weight, floor({_uniform('word', 'user_id', 'tier', 'jump')} * size)::BIGINT AS pos, sum(-ln({_uniform('gap', 'user_id', 'tier', 'jump')}) / (size * weight)) OVER (PARTITION BY user_id, tier ORDER BY jump) AS key FROM j
), each AS (SELECT user_id, tier, weight, unnest(range(0, size)) AS pos FROM o WHERE size < {ROOM} * ({EACH} + n)
), new AS (
  SELECT user_id, tier, pos, min(weight) AS weight, min(key) AS key FROM arrivals GROUP BY user_id, tier, pos UNION ALL SELECT user_id, tier, pos, weight, {_OWN_KEY} FROM each
), drawn AS (
  SELECT user_id, tier, pos, weight, key FROM new ANTI JOIN seen USING (user_id, tier, pos) UNION ALL SELECT user_id, tier, pos, weight, {_OWN_KEY} FROM seen WHERE weight > 0
), best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY key, tier, pos) AS rank FROM drawn)
SELECT user_id, rank, id, tier, round(weight, 9) AS weight FROM best JOIN p USING (tier, pos) WHERE rank <= {EACH}"""

NEIGHBOURS = f"{TOKENS}, n AS (SELECT * FROM (SELECT text, language, lead(text) OVER (PARTITION BY language, length(text) ORDER BY text) AS guess FROM lex) WHERE guess IS NOT NULL)"


def evaluated(g: str, t: str) -> str:
    """The letters of a guess with their states, as a list."""
    open_ = f"{g}[j] <> {t}[j]"
    return f"""list_transform(range(1, len({g}) + 1), lambda i: {g}[i] || ':' || CASE WHEN {g}[i] = {t}[i] THEN 'correct'
      WHEN len(list_filter(range(1, i + 1), lambda j: {open_} AND {g}[j] = {g}[i])) <= len(list_filter(range(1, len({g}) + 1), lambda j: {open_} AND {t}[j] = {g}[i])) THEN 'misplaced' ELSE 'wrong' END)"""


PLAYED = """
targets AS (
  SELECT o_orderkey AS session, lower(n_name) AS target FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), tried AS (
  SELECT DISTINCT l_orderkey AS session, l_linenumber * 10000000000000 + l_partkey * 1000000 + l_suppkey AS seq, n_name AS guess
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), marked AS (
  SELECT *, length(guess) = length(target) AS fits, lower(guess) = target AS hit FROM tried JOIN targets USING (session)
), counted AS (
  SELECT *, count(*) FILTER (fits) OVER before AS n_before, coalesce(bool_or(hit) OVER before, false) AS won, count(*) FILTER (fits) OVER upto AS turn FROM marked
  WINDOW before AS (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), upto AS (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), played AS (
  SELECT *, CASE WHEN won OR n_before >= 3 THEN 'finished' WHEN NOT fits THEN 'rejected' ELSE 'scored' END AS status FROM counted
)"""

_SHOWN = "CASE hint_level WHEN 'show_all' THEN string_split(text, '') WHEN 'off' THEN list_transform(string_split(text, ''), lambda c: '_') ELSE list_transform(string_split(text, ''), lambda c: CASE WHEN lower(strip_accents(c)) = lower(c) THEN c ELSE '_' END) END"

TYPED = f"""WITH {NEIGHBOURS}, h AS (SELECT *, CASE WHEN length(text) % 2 = 0 THEN 'off' ELSE 'show_unaccented' END AS hint_level, string_split(text, '') AS chars FROM n
    ), s AS (SELECT *, {_SHOWN} AS shown FROM h
    ), e AS (SELECT *, list_filter(range(1, len(chars) + 1), lambda k: shown[k] = '_') AS places FROM s
    ), f AS (
      SELECT *, list_reduce(list_transform(string_split(guess || text, ''), lambda c: {{'at': 0::BIGINT, 'misses': 0::BIGINT, 'rounds': 0::BIGINT, 'off': ''::VARCHAR, 'k': c}}),
        lambda acc, x: {{'at': acc.at + CASE WHEN acc.at < len(places) AND chars[places[acc.at + 1]] = x.k THEN 1 ELSE 0 END,
          'misses': acc.misses + CASE WHEN acc.at < len(places) AND chars[places[acc.at + 1]] <> x.k THEN 1 ELSE 0 END,
          'rounds': acc.rounds + CASE WHEN acc.at < len(places) THEN 1 ELSE 0 END,
          'off': CASE WHEN acc.at < len(places) AND chars[places[acc.at + 1]] <> x.k AND NOT contains(acc.off, x.k) THEN acc.off || x.k ELSE acc.off END, 'k': x.k}},
        {{'at': 0::BIGINT, 'misses': 0::BIGINT, 'rounds': 0::BIGINT, 'off': ''::VARCHAR, 'k': ''::VARCHAR}}) AS z FROM e
    )"""

TYPED_SESSIONS = f"""{TYPED}
    SELECT language || '/' || text AS session, {word_id("text", "language")} AS word_id,
      array_to_string(list_transform(range(1, len(chars) + 1), lambda k: CASE WHEN list_contains(places[1 : z.at], k) THEN chars[k] ELSE shown[k] END), '') AS display,
      array_to_string(list_sort(list_filter(string_split(z.off, ''), lambda c: c <> '')), '') AS disabled_keys, z.misses AS error_count, z.rounds AS rounds, z.at AS correct_rounds,
      len(places) > 0 AND z.at >= len(places) AS completed, CASE WHEN len(places) > 0 AND z.at >= len(places) THEN z.misses = 0 END AS correct FROM f"""

DEDUPED = rf"""WITH {TOKENS}, k AS (
      SELECT *, {word_id("text", "language")} AS id, CASE WHEN length(text) % 2 = 0 THEN 'noun' ELSE '' END AS pos,
        CASE WHEN length(text) <= 3 THEN 'high' WHEN length(text) <= 6 THEN 'medium' WHEN length(text) <= 9 THEN 'low' END AS freq,
        CASE WHEN _ord % 3 = 0 THEN '=' || text ELSE {folded("text")} END AS norm FROM tok
    ), base AS (
      SELECT id, min(_ord) AS _ord, coalesce(arg_min(text, _ord) FILTER (regexp_matches(text, '[^\x00-\x7F]')), arg_max(text, _ord) FILTER (text <> ''), arg_min(text, _ord)) AS text,
        arg_min(language, _ord) AS language, coalesce(arg_min(pos, _ord) FILTER (pos <> ''), arg_max(pos, _ord)) AS part_of_speech, arg_min(freq, _ord) FILTER (freq IS NOT NULL) AS frequency, arg_min(norm, _ord) AS normalized FROM k GROUP BY id
    ), tr AS (SELECT id, string_agg(source || '=' || v, '|' ORDER BY source) AS translations FROM (SELECT id, source, arg_min(reverse(text), _ord) AS v FROM k GROUP BY ALL) GROUP BY id
    ), tp AS (
      SELECT id, string_agg(topic, '|' ORDER BY o, pos) AS topics FROM (
        SELECT id, topic, min((_ord, pos))[1] AS o, min((_ord, pos))[2] AS pos FROM (SELECT id, _ord, 0 AS pos, source AS topic FROM k UNION ALL SELECT id, _ord, 1, 'length-' || length(text) FROM k) GROUP BY id, topic) GROUP BY id
    )
    SELECT id, _ord, text, language, normalized, part_of_speech, frequency, translations, topics, 'documents' AS sources, 0 AS n_glosses FROM base JOIN tr USING (id) JOIN tp USING (id)"""

USERS = "SELECT o_custkey::VARCHAR AS id, arg_max(o_orderpriority || '@example.org', o_orderkey) AS email, arg_max(o_orderstatus, o_orderkey) AS name, min(o_orderkey) AS first_ord FROM orders GROUP BY 1"

PORTIONS = r"""WITH s AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM conversations
), r AS (
  SELECT conv_id, turn, CASE WHEN len(w) = 0 THEN [] ELSE list_reduce(list_transform(w, lambda x: [x]), lambda acc, x:
    CASE WHEN length(x[1]) < 3 OR length(acc[len(acc)]) < 3 THEN list_append(acc[1 : len(acc) - 1], acc[len(acc)] || ' ' || x[1]) ELSE list_concat(acc, x) END) END AS p FROM s)"""

ORACLE_SQL = {
    "accent_stats": f"WITH {TOKENS} SELECT language, sum(uses)::BIGINT AS words, sum(CASE WHEN {ACCENT} THEN uses ELSE 0 END)::BIGINT AS accented, count(DISTINCT {word_id('text', 'language')}) AS ids FROM lex GROUP BY language",
    "normalize_tokens": f"WITH {TOKENS} SELECT text, language, uses, {folded('text')} AS plain, {folded(mapped('text'))} AS normalized, {ACCENT} AS has_accent, length(text) AS length FROM lex",
    "normalize_exact_tokens": f"WITH {TOKENS} SELECT text, language, {folded(mapped('text'))} AS normalized FROM lex",
    "accented_chars_hist": f"WITH {TOKENS}, c AS (SELECT language, uses, unnest(string_split(text, '')) AS letter FROM lex) SELECT language, letter, sum(uses)::BIGINT AS n FROM c WHERE {folded('letter')} <> lower(letter) GROUP BY ALL",
    "word_ids": f"WITH {TOKENS} SELECT text, language, {word_id('text', 'language')} AS id FROM lex",
    "language_lookup": f"SELECT doc_id, upper(lang) AS code, name, native_name, accent_keys FROM documents JOIN (VALUES {_LANGUAGES}) l(code, name, native_name, accent_keys) ON lower(lang) = l.code",
    "word_filter": f"WITH {TOKENS} SELECT _ord, text, language, {word_id('text', 'language')} AS id, {folded('text')} AS normalized FROM tok WHERE {ACCENT} AND source = 'src3' AND length(text) BETWEEN 4 AND 12 AND language IN ('fr', 'de')",
    "dedup_words": DEDUPED,
    "merged_in_steps": DEDUPED,
    "csv_vocabulary": f"""SELECT p_name || ' ' || p_partkey AS text, 'en' AS language, {word_id("p_name || ' ' || p_partkey", "'en'")} AS id, CASE WHEN p_size % 2 = 0 THEN lower(p_type) END AS part_of_speech,
      CASE WHEN p_size < 15 THEN 'high' WHEN p_size < 30 THEN 'low' END AS frequency, CASE WHEN p_size % 3 = 0 THEN reverse(p_name) END AS fr,
      p_brand || '|' || p_type || CASE WHEN p_size % 5 = 0 THEN '|"' || p_type || '"|x' ELSE '' END AS topics, CASE WHEN p_size % 7 = 0 THEN p_name || ',' || chr(10) || p_brand END AS sentence,
      CASE WHEN p_size % 4 = 0 THEN 'fr' END AS friend_language, CASE WHEN p_size % 4 = 0 THEN p_size + 0.5::DOUBLE END AS friend_score, 'csv' AS sources FROM part""",
    "wiktionary_vocabulary": f"""SELECT p_name || ' ' || p_partkey AS text, {word_id("p_name || ' ' || p_partkey", "'en'")} AS id, CASE p_size % 4 WHEN 0 THEN 'Noun' ELSE 'verb' END AS part_of_speech,
      1 AS n_glosses, p_type AS gloss, 1 AS n_examples, p_name AS english FROM part WHERE p_partkey % 50 NOT IN (7, 8) AND p_size % 4 IN (0, 2) AND p_size % 6 <> 0""",
    "static_vocabulary": f"SELECT n_name AS text, 'EN' AS language, {word_id('n_name', chr(39) + 'EN' + chr(39))} AS id, {folded('n_name')} AS normalized, length(n_name) AS length, 'static_list' AS sources FROM nation",
    "progress_totals": TOTALS,
    "progress_stream": TOTALS,
    "progress_in_steps": TOTALS,
    "progress_by_exercise": f"WITH {ATTEMPTS} SELECT user_id, word_id, exercise_type, {COUNTERS} FROM a WHERE exercise_type IS NOT NULL GROUP BY ALL",
    "word_weights": f"WITH {WEIGHTED} SELECT id, text, frequency, round(weight, 9) AS weight FROM w",
    "select_words": f"WITH {WEIGHTED} SELECT id, text, round(weight, 9) AS weight FROM (SELECT *, -ln((('0x' || substr(sha1('{SEED}|' || id || '|' || _ord), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / weight AS key FROM w WHERE weight > 0) ORDER BY key LIMIT {DRAWS}",
    "wordle_eval": f"WITH {NEIGHBOURS}, s AS (SELECT *, string_split(guess, '') AS g, string_split(text, '') AS t FROM n) SELECT language, text, guess, array_to_string({evaluated('g', 't')}, '|') AS letters FROM s",
    "wordle_session": f"WITH {PLAYED} SELECT session, seq, guess, status, status = 'scored' AND hit AS correct, CASE WHEN status = 'scored' THEN turn END AS attempt, status = 'scored' AND (hit OR turn >= 3) AS ends FROM played",
    "learners_words": LEARNERS,
    "live_wordle": f"""WITH {PLAYED}, lines AS (SELECT *, seq // 10000000000000 AS line FROM played
    ), last AS (SELECT session, max(seq) AS seq, max(line) AS line, bool_or(hit) AS won, count(*) FILTER (status = 'scored') AS turns FROM lines GROUP BY session
    )
    SELECT session, seq, guess, status, status = 'scored' AND hit AS correct, CASE WHEN status = 'scored' THEN turn END AS attempt, status = 'scored' AND (hit OR turn >= 3) AS ends,
      CASE WHEN status = 'finished' THEN 'Game already finished.' WHEN status = 'rejected' THEN 'Guess must be ' || length(target) || ' letters.' WHEN NOT hit THEN chr(39) || guess || chr(39) || ' is not the word.' END AS feedback FROM played
    UNION ALL SELECT session, seq, NULL, 'left', false, turns, false, NULL FROM last WHERE NOT won AND turns < 3 AND line + 2.5 < (SELECT max(line) FROM last) - 1""",
    "wordle_keyboard": f"""WITH {PLAYED}, s AS (SELECT session, string_split(lower(guess), '') AS g, string_split(target, '') AS t FROM played WHERE status = 'scored'
    ), x AS (SELECT session, unnest({evaluated("g", "t")}) AS l FROM s
    ), k AS (SELECT session, l[1] AS letter, max(list_position(['unused', 'wrong', 'misplaced', 'correct'], l[3:])) AS rank FROM x GROUP BY ALL)
    SELECT session, letter, (['unused', 'wrong', 'misplaced', 'correct'])[rank] AS state FROM k""",
    "diacritic_display": f"WITH {TOKENS}, h AS (SELECT text, language, unnest(['off', 'show_unaccented', 'show_all']) AS hint_level FROM lex) SELECT text, language, hint_level, array_to_string({_SHOWN}, '') AS display FROM h",
    "diacritic_session": TYPED_SESSIONS,
    "live_typing": TYPED_SESSIONS,
    "typed_progress": f"""{TYPED}, a AS (SELECT language AS user_id, {word_id("text", "language")} AS word_id, 'diacritic_typing' AS exercise_type, z.misses = 0 AS correct, TIMESTAMP '2024-03-01' AS "when", 0 AS _ord FROM f WHERE len(places) > 0 AND z.at >= len(places))
    SELECT user_id, word_id, exercise_type, {COUNTERS} FROM a GROUP BY ALL""",
    "pair_matching": f"""WITH pairs AS (SELECT p_size AS round, p_name AS "left", arg_max(reverse(p_type), p_partkey) AS expected FROM part GROUP BY ALL
    ), taps AS (SELECT p_size AS round, p_name AS "left", reverse(p_type) AS "right" FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT t.round, t."left", t."right", {word_id('t."left"', "'en'")} AS word_id, expected = "right" AS correct, count(*) AS taps FROM taps t JOIN pairs p ON t.round = p.round AND t."left" = p."left" GROUP BY ALL""",
    "matching_columns": f"""WITH pairs AS (SELECT p_size AS round, p_name AS "left", arg_max(reverse(p_type), p_partkey) AS "right", min(p_partkey) AS place FROM part GROUP BY ALL)
    SELECT round, string_agg("left", '|' ORDER BY place) AS left_words, string_agg("right", '|' ORDER BY sha1('{SEED}|' || round || '|' || "left"), "right") AS right_words FROM pairs GROUP BY round""",
    "sentence_rounds": rf"""{PORTIONS}, e AS (SELECT r.conv_id, r.turn, r.p, text FROM r JOIN conversations c ON r.conv_id = c.conv_id AND r.turn = c.turn
    ), f AS (SELECT *, list_transform(list_sort(list_transform(range(1, len(p) + 1), lambda k: {{'key': sha1('{SEED}|' || text || '|' || (k - 1) || '|' || p[k]), 'p': p[k]}})), lambda x: x.p) AS q FROM e)
    SELECT conv_id, turn, array_to_string(p, '|') AS expected, array_to_string(q, '|') AS shuffled, p = q AS shuffled_right, true AS expected_right FROM f""",
    "union_vocabulary": f"""WITH w AS (SELECT n_name AS name, false AS from_region FROM nation UNION ALL SELECT r_name, true FROM region
    ), t AS (SELECT array_to_string(list_transform(string_split(name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS text, from_region FROM w)
    SELECT {word_id("text", "'en'")} AS id, text, {folded("text")} AS normalized, bool_and(from_region) AS from_region FROM t GROUP BY text""",
    "offered_words": f"WITH {TOKENS} SELECT text, language, uses FROM lex WHERE length({folded('text')}) IN (4, 5, 6, 7)",
    "typing_prompts": f"WITH {TOKENS}, h AS (SELECT text, language, CASE WHEN length(text) % 2 = 0 THEN 'off' ELSE 'show_unaccented' END AS hint_level FROM lex) SELECT text, language, array_to_string({_SHOWN}, '') AS display, 'like ' || text AS gloss_texts FROM h",
    "accented_dictionary": f"WITH {TOKENS} SELECT text, 'noun' AS part_of_speech, count(*) AS n FROM lex WHERE {ACCENT} GROUP BY text",
    "played_progress": f"""WITH {PLAYED}, e AS (SELECT session, hit AS correct FROM played WHERE status = 'scored' AND (hit OR turn >= 3)
    ), a AS (SELECT o_custkey::VARCHAR AS user_id, {word_id("n_name", "'en'")} AS word_id, 'wordle' AS exercise_type, correct, o_orderdate AS "when", o_orderkey AS _ord
      FROM e JOIN orders ON session = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT user_id, word_id, exercise_type, {COUNTERS} FROM a GROUP BY ALL""",
    "matched_progress": f"""WITH pairs AS (SELECT p_size AS round, p_name AS "left", arg_max(reverse(p_type), p_partkey) AS expected FROM part GROUP BY ALL
    ), taps AS (SELECT p_size AS round, p_name AS "left", reverse(p_type) AS "right" FROM lineitem JOIN part ON l_partkey = p_partkey
    ), a AS (SELECT 'u' || t.round AS user_id, {word_id('t."left"', "'en'")} AS word_id, 'pair_matching' AS exercise_type, expected = "right" AS correct, TIMESTAMP '2024-03-01' AS "when", 0 AS _ord FROM taps t JOIN pairs p ON t.round = p.round AND t."left" = p."left")
    SELECT user_id, word_id, exercise_type, {COUNTERS} FROM a GROUP BY ALL""",
    "tutor_sessions": """SELECT conv_id AS session, 'tutor: travel?|user: ' || arg_min(text, turn) || '|tutor: travel: ' || arg_min(text, turn) AS history, true AS correct, NULL::VARCHAR AS feedback FROM conversations WHERE role = 'user' GROUP BY conv_id""",
    "sentence_portions": rf"""{PORTIONS}
    SELECT conv_id, turn, array_to_string(p, '|') AS portions, len(p)::INTEGER AS n_portions FROM r""",
    "tutor_turns": """WITH t AS (
      SELECT conv_id AS session, turn, CASE role WHEN 'assistant' THEN 'tutor' ELSE role END AS role, CASE length(text) % 3 WHEN 0 THEN ' ' WHEN 1 THEN text END AS correction FROM conversations WHERE role <> 'system'
    ), l AS (SELECT *, lead(role) OVER w AS next_role, lead(correction) OVER w AS c, row_number() OVER w AS n FROM t WINDOW w AS (PARTITION BY session ORDER BY turn))
    SELECT session, turn, n AS history_length, coalesce(trim(c), '') = '' AS correct, c AS feedback FROM l WHERE role = 'user' AND next_role = 'tutor'""",
    "session_summary": f"""WITH {ATTEMPTS} SELECT concat_ws('/', user_id, exercise_type) AS session, arg_min(exercise_type, "when") AS exercise_type, count(*) AS total_rounds, count(*) FILTER (correct) AS correct_rounds,
      coalesce(array_to_string(list_sort(list(DISTINCT word_id) FILTER (NOT correct)), '|'), '') AS words_practiced, date_diff('microsecond', min("when"), max("when")) / 1e6::DOUBLE AS duration_seconds FROM a GROUP BY 1""",
    "user_upsert": USERS,
    "users_in_steps": USERS,
    "streamed_sessions": STREAMED_SESSIONS,
    "practised_in_steps": f"""WITH {ATTEMPTS} SELECT user_id, date_trunc('week', "when")::DATE AS week, count(DISTINCT word_id) AS words
    FROM a GROUP BY GROUPING SETS ((user_id, date_trunc('week', "when")), (user_id))""",
    "generated_translations": "SELECT conv_id, turn, '[en] ' || text AS translated_text, true AS valid FROM conversations",
    "generated_conversations": "SELECT n_name AS topic, 6 AS n_turns, 'user|system|user|system|user|system' AS roles, true AS valid FROM nation",
    "generated_tutoring": "SELECT conv_id, turn, 'travel: ' || text AS content, 0 AS n_errors, true AS valid FROM conversations WHERE role = 'user'",
    "generated_topics": "SELECT n_name AS topic, array_to_string(list_transform([1, 2, 3], lambda k: 'fr ' || n_name || ' topic ' || k), '|') AS topics, true AS valid FROM nation",
    "generated_portions": r"""WITH s AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w FROM conversations)
    SELECT conv_id, turn, array_to_string(list_transform(range(0, (len(w) + 2) // 3), lambda k: array_to_string(w[3 * k + 1 : 3 * k + 3], ' ')), '|') AS portions, true AS valid FROM s""",
    "generated_greetings": "SELECT n_name AS topic, n_name || '?' AS greeting, true AS valid FROM nation",
    "generated_words": "SELECT n_name AS topic, array_to_string(list_transform(range(1, 11), lambda k: n_name || CASE WHEN ends_with(n_name, '1') THEN 'é' ELSE '' END || k), '|') AS words, true AS valid FROM nation",
}
