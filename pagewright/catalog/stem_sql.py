"""Porter2 stems as SQL: a chain of named selects, one for each step of the algorithm."""

from pagewright.functions import stem

SHORT = "regexp_matches({0}, '(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$')"
REGION = "regexp_extract({0}, '^.*?[aeiouy][^aeiouy]')"


def _list(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def _case(of: str, table: dict[str, str]) -> str:
    return f"CASE {of} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + " END"


def _cut(name: str, source: str, endings) -> str:
    """``name``: rows of ``source`` with the longest of ``endings`` that the word has, and what is before it."""
    found = f"regexp_extract(word, '({'|'.join(endings)})$')"
    return f"{name} AS (SELECT *, {found} AS ending, left(word, length(word) - length({found})) AS base FROM {source})"


def _replaced(name: str, source: str, region: str, table: dict[str, str]) -> str:
    """``name``: the endings of ``table`` that begin in ``region`` replaced, four of them on a condition."""
    return f"""{_cut(name + '_cut', source, table)},
{name} AS (SELECT term, r1, r2, CASE
    WHEN ending = '' OR length(base) < {region} THEN word
    WHEN ending = 'ogi' AND NOT regexp_matches(base, 'l$') THEN word
    WHEN ending = 'li' AND NOT regexp_matches(base, '[cdeghkmnrt]$') THEN word
    WHEN ending = 'ative' AND length(base) < r2 THEN word
    WHEN ending = 'ion' AND NOT regexp_matches(base, '[st]$') THEN word
    ELSE base || {_case('ending', table)} END AS word
  FROM {name}_cut)"""


def stems_sql(source: str) -> str:
    """``stems`` (term, stem) of the distinct terms of ``source``, lower-case words."""
    prefix = f"regexp_extract(word, '^({'|'.join(stem.LONG_PREFIXES)})')"
    first, second = REGION.format("word"), REGION.format("substr(word, r1 + 1)")
    whole, kept = _list(stem.WHOLE_WORDS), _list(stem.KEPT_AFTER_PLURAL)
    return rf"""
vocabulary AS (SELECT DISTINCT term FROM {source}),
marked AS (
  SELECT term, regexp_replace(regexp_replace(regexp_replace(regexp_replace(term, '^''', ''),
    '([aeiou])y', '\1Y', 'g'), '([^aeiouyY]y)y', '\1Y', 'g'), '^y', 'Y') AS word
  FROM vocabulary WHERE length(term) > 2 AND term NOT IN ({whole})),
region_1 AS (SELECT *, CASE WHEN {prefix} <> '' THEN length({prefix})
    WHEN {first} <> '' THEN length({first}) ELSE length(word) END AS r1 FROM marked),
region_2 AS (
  SELECT term, r1, CASE WHEN {second} <> '' THEN r1 + length({second}) ELSE length(word) END AS r2,
    regexp_replace(word, '(''s''|''s|'')$', '') AS word
  FROM region_1),
singular AS (SELECT term, r1, r2, CASE
    WHEN regexp_matches(word, 'sses$') THEN left(word, -2)
    WHEN regexp_matches(word, 'ie[ds]$') THEN left(word, CASE WHEN length(word) > 4 THEN -2 ELSE -1 END)
    WHEN regexp_matches(word, '[aeiouy].*[^us]s$') THEN left(word, -1)
    ELSE word END AS word FROM region_2),
others AS (SELECT * FROM singular WHERE word NOT IN ({kept})),
{_cut('past', 'others', ['eedly', 'ingly', 'edly', 'eed', 'ing', 'ed'])},
present AS (SELECT term, r1, r2, CASE
    WHEN ending = '' THEN word
    WHEN ending IN ('eed', 'eedly') THEN CASE WHEN length(base) >= r1 THEN base || 'ee' ELSE word END
    WHEN NOT regexp_matches(base, '[aeiouy]') THEN word
    WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
    WHEN regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(base, -1)
    WHEN length(base) <= r1 AND {SHORT.format('base')} THEN base || 'e'
    ELSE base END AS word FROM past),
vowel_end AS (SELECT term, r1, r2, regexp_replace(word, '(.[^aeiouy])[yY]$', '\1i') AS word FROM present),
{_replaced('step_2', 'vowel_end', 'r1', stem.STEP_2)},
{_replaced('step_3', 'step_2', 'r1', stem.STEP_3)},
{_replaced('step_4', 'step_3', 'r2', dict.fromkeys(stem.STEP_4, ''))},
step_5 AS (SELECT term, CASE
    WHEN regexp_matches(word, 'e$') AND (length(word) > r2 OR length(word) > r1 AND NOT {SHORT.format('left(word, -1)')})
      THEN left(word, -1)
    WHEN regexp_matches(word, 'll$') AND length(word) > r2 THEN left(word, -1)
    ELSE word END AS word FROM step_4),
stems AS (
  SELECT term, replace(word, 'Y', 'y') AS stem FROM step_5
  UNION ALL SELECT term, word FROM singular WHERE word IN ({kept})
  UNION ALL SELECT term, coalesce({_case('term', stem.WHOLE_WORDS)}, term) FROM vocabulary
    WHERE length(term) <= 2 OR term IN ({whole}))"""
