"""DuckDB SQL for the same expressions, to check results by."""

from __future__ import annotations

from ..lexicon import BAD_ENDINGS, DOMAINS, GENERIC_TERMS, JOINED_WORDS, LANGUAGES, MISREAD_PATTERN, STOPWORDS


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def sub(x: str, *rules: tuple[str, str]) -> str:
    for pattern, to in rules:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(to)}, 'g')"
    return x


def strip(x: str) -> str:
    return sub(x, ("^\\s+|\\s+$", ""))


def collapse_space(x: str) -> str:
    return strip(sub(f"coalesce({x}, '')", ("\\r\\n?", "\n"), ("[ \\t]+", " "), ("\\n{3,}", "\n\n")))


def fold(x: str) -> str:
    return f"strip_accents(lower(coalesce({x}, '')))"


def found(x: str, pattern: str) -> str:
    return f"regexp_extract_all({x}, {quoted(pattern)})"


def without(tokens: str, dropped=STOPWORDS) -> str:
    return f"list_filter({tokens}, lambda w: NOT list_contains({listed(dropped)}, w))"


def content_words(x: str) -> str:
    return without(found(fold(x), "[A-Za-zÀ-ÿ]{4,}"))


def terms(x: str) -> str:
    f = fold(x)
    return f"list_distinct(list_concat({without(found(f, '[A-Za-z][A-Za-z-]{3,}'))}, {found(f, '[A-Za-z]+(?:-[A-Za-z]+)+')}))"


def signature(x: str) -> str:
    return sub(f"lower({strip(f'coalesce({x}, chr(32))')})", ("\\s+", " "), ("[^\\p{L}\\p{N}_\\s]", ""))


def pairs(tokens: str) -> str:
    return f"list_distinct(CASE WHEN len({tokens}) < 2 THEN {tokens} ELSE list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]) END)"


def answer_tokens(x: str) -> str:
    return found(f"lower(coalesce({x}, ''))", "[A-Za-zÀ-ÿ0-9]{3,}")


def question_tokens(x: str) -> str:
    return without(found(f"lower(coalesce({x}, ''))", "[A-Za-zÀ-ÿ]{4,}"))


def repair_joined(x: str) -> str:
    return sub(x, *((f"(?i)\\b{a}\\b", b) for a, b in JOINED_WORDS))


def language_score(code: str, sample: str, tokens: str) -> str:
    marks = {c: m for c, _, m in LANGUAGES}[code]
    bonus = {"es": ("[ñ¿¡]", 8), "fr": (" l'| d'| qu'|[àèç]", 4), "ca": (" l'| d'| qu'|[àèç]", 2), "pt": ("ção|ões|ã|õ", 6)}.get(code)
    score = f"len(list_filter({tokens}, lambda w: list_contains({listed(marks)}, w)))"
    return score if bonus is None else f"({score} + CASE WHEN regexp_matches({sample}, {quoted(bonus[0])}) THEN {bonus[1]} ELSE 0 END)"


#: Question-answer items from turns of conversations; runs in Spark and in DuckDB.
ITEMS = """
SELECT concat('conv-', u.conv_id, '-topic-', lpad(cast(u.conv_id % 8 AS STRING), 2, '0'), '-qa-', lpad(cast(u.turn AS STRING), 2, '0')) AS id,
       u.conv_id * 100 + u.turn AS seq, u.text AS question,
       CASE u.conv_id % 3 WHEN 0 THEN substring(a.text, 1, 160) WHEN 1 THEN u.text ELSE b.text END AS answer,
       CASE (u.conv_id + u.turn) % 5 WHEN 0 THEN 'factual' WHEN 1 THEN 'conceptual' WHEN 2 THEN 'inference' WHEN 3 THEN 'compare' ELSE 'definition' END AS type,
       a.text AS context_source, u.conv_id % 5 <> 0 AS context_source_verified,
       concat('topic-', lpad(cast(u.conv_id % 8 AS STRING), 2, '0')) AS topic_id, concat('conv-', u.conv_id % 10) AS document
FROM {conversations} u
JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
LEFT JOIN {benchmark} b ON b.item_id = u.conv_id % 40
WHERE u.role = 'user'
"""
#: A topic for each document and topic id of the items, from a passage's first words.
ITEM_TOPICS = """
SELECT document, topic_id, topic_index, name, summary, keywords FROM (
  SELECT concat('conv-', item_id % 10) AS document, concat('topic-', lpad(cast(item_id % 8 AS STRING), 2, '0')) AS topic_id, cast(item_id % 8 AS INT) AS topic_index,
         regexp_extract(text, '^([^ ]+ [^ ]+)', 1) AS name, substring(text, 1, 60) AS summary, regexp_extract_all(substring(text, 1, 120), '([a-z][a-z][a-z][a-z][a-z]+)', 1) AS keywords,
         row_number() OVER (PARTITION BY item_id % 10, item_id % 8 ORDER BY item_id) AS n
  FROM {benchmark}) t WHERE n = 1
"""
ITEMS_CTE = "items AS (" + ITEMS.format(conversations="conversations", benchmark="benchmark") + ")"
TOPICS_CTE = "topics AS (" + ITEM_TOPICS.format(benchmark="benchmark") + ")"


def chunks_cte(size: int, overlap: int, table: str = "documents") -> str:
    step = max(1, size - overlap)
    edge = "length(part) - strpos(reverse(replace(part, chr(10), ' ')), ' ')"
    return f"""
cleaned AS (SELECT doc_id::VARCHAR AS document, {collapse_space('text')} AS t FROM {table}),
starts AS (SELECT document, t, length(t) AS n, unnest(range(0, greatest(ceil((length(t) - {size}) / {step}.0), 0)::BIGINT + 1)) * {step} AS s FROM cleaned),
parts AS (SELECT *, substr(t, (s + 1)::BIGINT, {size}) AS part FROM starts),
windows AS (
  SELECT document, s, {strip(f"CASE WHEN s + {size} < n AND regexp_matches(substr(t, (s + {size})::BIGINT, 1), '[\\p{{L}}\\p{{N}}]') AND regexp_matches(substr(t, (s + {size} + 1)::BIGINT, 1), '[\\p{{L}}\\p{{N}}]') AND strpos(reverse(replace(part, chr(10), ' ')), ' ') > 0 AND {edge} >= {max(step, int(size * 0.6))} THEN substr(part, 1, {edge}) ELSE part END")} AS text FROM parts),
chunks AS (SELECT document, (row_number() OVER (PARTITION BY document ORDER BY s) - 1)::INT AS chunk_index, text FROM windows WHERE length(text) >= 120)"""


def noisy(c: str) -> str:
    s = strip(c)
    return (
        f"(regexp_matches({s}, '(?:^|\\s)(?:---\\s*){{2,}}') OR regexp_matches(lower({s}), '^(?:uld |lic |sary |tions |tive )')"
        f" OR (regexp_matches({s}, '^[^\\s\\p{{Lu}}]*\\p{{Ll}}[^\\s\\p{{Lu}}]*\\s+\\p{{Lu}}') AND length(regexp_extract({s}, '^\\S+')) >= 4)"
        f" OR len(regexp_extract_all({s}, '[\\p{{L}}\\p{{N}}_]+-\\s+[\\p{{L}}\\p{{N}}_]+')) >= 4"
        f" OR (length({s}) >= 500 AND length(regexp_replace({s}, '[^\\p{{L}}]', '', 'g')) / greatest(length({s}), 1) < 0.45))"
    )


def mentions(haystack: str, phrases: str) -> str:
    low = f"list_filter(list_transform({phrases}, lambda p: {strip('lower(p)')}), lambda p: p <> '')"
    return f"coalesce(list_sum(list_transform({low}, lambda p: (CASE WHEN contains({haystack}, p) THEN 4 ELSE 0 END) + len(list_filter(regexp_split_to_array(p, '\\s+'), lambda w: length(w) > 3 AND contains({haystack}, w))))), 0)::INT"


def keywords(x: str, k: int = 8) -> str:
    tokens = without(found(f"lower({x})", "[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9_-]{3,}"))
    rows = f"list_transform(list_distinct({tokens}), lambda w: {{'a': -len(list_filter({tokens}, lambda v: v = w)), 'b': list_position({tokens}, w), 'w': w}})"
    return f"list_transform(list_sort({rows})[1:{k}], lambda r: r.w)"


def valid_name(c: str) -> str:
    real = f"len({found(c, '[A-Za-zÀ-ÿ]{3,}')})"
    return (
        f"CASE WHEN {c} IS NULL OR length({c}) < 5 THEN false WHEN regexp_matches({c}, '^[\\dA-Z][\\d.]*\\s+[A-Za-z]') THEN {real} >= 1"
        f" ELSE regexp_matches({c}, '^\\p{{L}}') AND {real} >= 1 AND ({real} >= 2 OR regexp_matches({c}, '[A-Za-zÀ-ÿ]{{6,}}')) AND length({c}) - length(replace({c}, '/', '')) <= 2 END"
    )


def covered(answer: str, source: str) -> str:
    own, other = pairs(answer_tokens(answer)), pairs(answer_tokens(source))
    return f"CASE WHEN len({own}) > 0 THEN len(list_intersect({own}, {other})) / len({own}) ELSE 0.0 END"


def word_count(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


MARKER = "\\[[^\\]]+-chunk-\\d{4,}\\]"


def rules() -> dict[str, str]:
    """The rules over the items, which have no excerpt, topic or keywords here."""
    from ..operators.quality import SUPPORT, TRACES

    q, a, s = "coalesce(question, '')", "coalesce(answer, '')", "coalesce(context_source, '')"
    body = f"lower({q} || ' ' || {a} || ' ' || {s} || '  ')"
    traces = "|".join(f"(?:{t})" for t in TRACES)
    clean = collapse_space(s)
    dangling = f"(length({clean}) >= 20 AND regexp_matches({clean}, '\\.\\s+[A-Z]\\.\\s*$'))"
    own, base = f"list_distinct({content_words(a)})", f"list_distinct({content_words(s)})"
    new = f"len(list_filter({own}, lambda w: NOT list_contains({base}, w)))"
    limits = " ".join(f"WHEN '{k}' THEN (len({own}) - {new}) / greatest(len({own}), 1) <= {lo} OR {new} >= {hi}" for k, (lo, hi) in SUPPORT.items())
    number = "\\d+(?:[.,]\\d+)?%?"
    fresh = f"len(list_filter({content_words(a)}, lambda w: NOT list_contains({content_words(q)}, w)))"
    numbers = f"len(list_filter(list_distinct({found(a, number)}), lambda w: NOT list_contains({found(q, number)}, w)))"
    word = f"regexp_extract(lower({clean}), '([A-Za-z]+)[^\\p{{L}}\\p{{N}}_]*$', 1)"
    return {
        "cross_chunk_context": f"regexp_matches({s}, {quoted(MARKER)})",
        "artifact_or_reference_noise": f"(regexp_matches({body}, {quoted(traces)}) OR regexp_matches({s}, '(?:^|\\s)(?:---\\s*){{2,}}') OR contains(lower({s}), 'forthcoming') OR regexp_matches({s} || ' ' || {a} || ' ' || {q}, {quoted(MISREAD_PATTERN)}) OR regexp_matches({s}, {quoted(MARKER)}) OR {dangling})",
        "truncated_context_source": f"({clean} <> '' AND (regexp_matches({clean}, '^[^\\s\\p{{Lu}}]*\\p{{Ll}}[^\\s\\p{{Lu}}]*\\s+\\p{{Lu}}') OR regexp_matches({clean}, '^[a-z]{{3,}}(?:[^\\p{{L}}\\p{{N}}_]|$)') OR (length({clean}) > 120 AND NOT regexp_matches({clean}, '[.;:!?)\\]]$')) OR (length({clean}) > 40 AND list_contains({listed(BAD_ENDINGS)}, {word}))))",
        "first_person_answer": f"regexp_matches(lower({collapse_space(a)}), '^(?:we|our)\\b')",
        "topic_mismatch": "false",
        "verbatim_answer": f"({word_count(collapse_space(a))} >= 6 AND {word_count(clean)} >= 10 AND {covered(collapse_space(a), clean)} >= 0.7)",
        "insufficient_context_support": f"(lower(type) IN ('inference', 'compare', 'definition', 'factual') AND len({own}) >= 6 AND (len({base}) = 0 OR CASE lower(type) {limits} ELSE false END))",
        "circular_answer": f"(len({content_words(a)}) = 0 OR {fresh} + {numbers} < 3)",
        "unverified_context_source": "NOT coalesce(context_source_verified, false)",
    }


def first_reason() -> str:
    return "CASE " + " ".join(f"WHEN {rule} THEN {quoted(name)}" for name, rule in rules().items()) + " END"


def alignment(*parts: str) -> str:
    return f"list_filter({terms(' || chr(32) || '.join(parts))}, lambda t: NOT list_contains({listed(GENERIC_TERMS)}, t) AND length(t) >= 4)"


def domain_hits(x: str) -> dict[str, str]:
    return {d: f"len(list_filter({terms(x)}, lambda t: list_contains({listed(v)}, t)))" for d, v in DOMAINS.items()}
