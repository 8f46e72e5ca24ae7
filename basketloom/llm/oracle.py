"""DuckDB SQL of those operator queries that SQL can express."""

from __future__ import annotations

from basketloom.llm.quality_rules import BINS, BLANKS, CLASSES, COMMON_WORDS, QualityParams
from basketloom.llm.queries import SPAM_LABELS, URL_RULES


def _fits(rule: str) -> str:
    at, _, rest = rule.partition("/")
    return f"((host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{rest}'))"


def _url_filter() -> str:
    rules = sorted(URL_RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in rules)
    way = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in rules)
    spam = " OR ".join(f"contains(host, '{x}.')" for x in SPAM_LABELS)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT *, CASE {rule} END AS rule,
         regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html|/+)$', '') AS canonical FROM named),
listed AS (SELECT DISTINCT canonical FROM ruled WHERE ({spam}) AND canonical <> '')
SELECT page_id, host, path, rule,
       CASE {way} WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN listed l ON r.canonical = l.canonical"""


def _distance(counts: str, reference: str) -> str:
    """Jensen-Shannon distance of two count lists."""
    def half(p: str, q: str) -> str:
        return f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
    p, q = f"({counts}[i] / list_sum({counts}))", f"({reference}[i] / list_sum({reference}))"
    terms = f"list_sum(list_transform(range(1, len({counts}) + 1), lambda i: {half(p, q)} + {half(q, p)}))"
    return f"CASE WHEN list_sum({counts}) > 0 THEN sqrt(greatest(0.0, {terms} / 2)) END"


def _quality_rules() -> str:
    p = QualityParams()
    white = "[\x20\x09-\x0D]"
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    bins = ", ".join(f"len(list_filter(words, lambda w: w = '{c}'))" for c in BINS)
    other = f"len(list_filter(words, lambda w: w NOT IN ({', '.join(repr(c) for c in BINS)})))"
    class_sums = ", ".join(f"sum(classes[{i + 1}])" for i in range(len(CLASSES)))
    word_sums = ", ".join(f"sum(commons[{i + 1}])" for i in range(len(BINS) + 1))

    def count(pattern: str) -> str:
        return f"(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')))"

    points, odd = "[.,;:!?()''\"-]", "[@=+_~^`{}\\[\\]\\\\/]"
    return f"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, CASE WHEN trim(text, {blanks}) = '' THEN [] ELSE string_split_regex(trim(text, {blanks}), '{white}+') END AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM split)),
found AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT doc_id, sum(least(3, coalesce(next - p, 3)))::BIGINT AS n
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM found) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, lang, text, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         {count('[#*$%&|<>]')}::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, length(text) AS n_chars, {count('[A-Z]')} AS upper,
         {count(points)} AS points, {count(odd)} AS odd, strlen(text) - length(text) AS wide, [{bins}, {other}] AS commons
  FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id),
features AS (
  SELECT *, [n_chars - upper - points - odd - n_symbols - (n_chars - word_chars), upper, points, odd + n_symbols,
             n_chars - word_chars, wide] AS classes FROM counted),
refs AS (
  SELECT [{class_sums}] AS c, [{word_sums}] AS w FROM features
  WHERE lang IN ({', '.join(repr(x) for x in COMMON_WORDS)}) AND 100 * n_symbols <= {p.max_reference_symbol_percent} * n_words
  GROUP BY lang),
known AS (
  SELECT *, coalesce(lang IN ({', '.join(repr(x) for x in COMMON_WORDS)}), TRUE) AS listed,
         CASE WHEN listed THEN classes ELSE list_append(classes[1:{len(CLASSES) - 1}], 0) END AS script_free FROM features),
nearest AS (
  SELECT f.doc_id, min({_distance('script_free', 'c')}) AS class_distance,
         min(CASE WHEN listed THEN {_distance('commons', 'w')} END) AS word_distance
  FROM known f, refs GROUP BY f.doc_id),
judged AS (
  SELECT f.*, n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words AS base_failed,
         coalesce(n_chars >= {p.min_class_chars} AND class_distance > {p.max_class_distance}, FALSE) AS odd_classes,
         coalesce(n_words >= {p.min_histogram_words} AND word_distance > {p.max_word_distance}, FALSE) AS odd_words
  FROM features f LEFT JOIN nearest n ON f.doc_id = n.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT odd_classes AND NOT odd_words AS kept FROM judged"""


def _collocations() -> str:
    return r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
parts AS (
  SELECT lang, m, unnest([array_to_string(ws[i : i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM cut, range(1, 5) AS sizes(m) WHERE len(ws) >= m),
counted AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM parts GROUP BY lang, phrase),
often AS (SELECT lang, phrase, m, f, string_split(phrase, ' ') AS ws FROM counted WHERE f >= 30),
sides AS (
  SELECT lang, phrase, f AS a, k, array_to_string(ws[1 : k], ' ') AS before, array_to_string(ws[k + 1 :], ' ') AS after
  FROM often, range(1, 4) AS places(k) WHERE m > k),
cuts AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, 2000000::HUGEINT * a // (x.f + y.f) AS score
  FROM sides c JOIN often x ON x.lang = c.lang AND x.phrase = before JOIN often y ON y.lang = c.lang AND y.phrase = after),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT o.lang, array_to_string(o.ws[i : i + s - 1], ' ') AS phrase, max(o.f) AS longer
  FROM often o, range(2, 4) AS sizes(s), range(1, 4) AS places(i)
  WHERE s < o.m AND i + s - 1 <= o.m GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


def llm_oracles() -> dict[str, str]:
    return {"op2_quality_rules": _quality_rules(), "op10_url_filter": _url_filter(), "op11_collocations": _collocations()}
