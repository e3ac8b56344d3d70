"""SQL for what the contracts fix of operators whose own part SQL can't express: their base columns."""

from __future__ import annotations

PRIVATE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


SECRET = {
    "assign": rf"""(?:{_any_case("password|passwd|secret|token")}|{_any_case("api")}_?{_any_case("key")})["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def _spans(kind: str, pattern: str, test: str, group: bool = False) -> str:
    """doc_id, kind, a, b (code points, end exclusive) of the matches that pass: pieces between matches give the places."""
    p = "'" + pattern.replace("'", "''") + "'"
    inner = f", regexp_extract_all(t, {p}, 1) AS g" if group else ""
    return f"""SELECT doc_id, '{kind}' AS kind, a, a + len(v) AS b, v FROM (
    SELECT doc_id, ms[i] AS v{', g[i] AS g' if group else ''}, list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS a
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS gaps{inner} FROM d))
  ) WHERE {test}"""


_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, len({_DIGITS}) + 1), lambda k: CASE WHEN k % 2 = 1 THEN CAST(reverse({_DIGITS})[k] AS INT) ELSE CAST(reverse({_DIGITS})[k] AS INT) * 2 - CASE WHEN CAST(reverse({_DIGITS})[k] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
_DOCS = "d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"


def _listed(kinds: dict, order: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in kinds)
    zero = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in kinds)
    return f"SELECT d.doc_id, {zero}, sha256(coalesce(joined, '')) AS base_sha256 FROM d LEFT JOIN (SELECT doc_id, {counts}, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY {order}) AS joined FROM found GROUP BY doc_id) USING (doc_id)"


_NTH = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate([*PRIVATE, *SECRET])) + " END"
PRIVATE_SQL = f"""WITH {_DOCS}, found AS (
  {_spans("email", PRIVATE["email"], "true")}
  UNION ALL {_spans("ip", PRIVATE["ip"], "list_max(list_transform(string_split(v, '.'), lambda x: CAST(x AS HUGEINT))) <= 255")}
  UNION ALL {_spans("card", PRIVATE["card"], f"len({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}")}
  UNION ALL {_spans("phone", PRIVATE["phone"], f"len({_DIGITS}) BETWEEN 8 AND 15")}
) {_listed(PRIVATE, f"{_NTH}, a")}"""
SECRET_SQL = f"""WITH {_DOCS}, found AS (
  {_spans("assign", SECRET["assign"], "len(g) >= 8", group=True)}
  UNION ALL {_spans("access", SECRET["access"], "len(v) >= 16")}
  UNION ALL {_spans("hex", SECRET["hex"], "len(v) >= 32")}
) {_listed(SECRET, f"a, {_NTH}")}"""

QUALITY_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t\n\v\f\r]+') AS ws FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \t\n\v\f\r]') GROUP BY doc_id),
grams AS (SELECT doc_id, p, array_to_string(ws[p:p + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM d)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars, len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
) SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted"""
