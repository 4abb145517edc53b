"""What DuckDB must say to the queries that SQL can express."""

from __future__ import annotations

from samedays.llm.urls import SUFFIXES

_DOCUMENTS = r"""numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM numbered)"""

#: Measures, bits of the rules and both verdicts, from the definitions.
QUALITY = rf"""WITH {_DOCUMENTS},
windows AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM split)),
counted AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS times FROM windows),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM counted, range(3) t(k) WHERE times > 1 GROUP BY rid),
lines AS (
  SELECT rid, line FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM numbered)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lined AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines GROUP BY rid),
measured AS (
  SELECT s.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (rid) LEFT JOIN lined l USING (rid)),
failing AS (
  SELECT *, n_words < 50 AS few, 100 * n_repeat_words > 50 * n_words AS repeating, 10 * n_symbols > 3 * n_words AS signs,
         100 * n_dup_lines > 30 * n_lines AS same_lines, word_chars < 2 * n_words OR word_chars > 20 * n_words AS odd_words,
         2 * n_upper > word_chars AS shouting FROM measured),
bits AS (
  SELECT *, cast(few AS bigint) + 2 * cast(repeating AS bigint) + 4 * cast(signs AS bigint) + 8 * cast(same_lines AS bigint)
            + 16 * cast(odd_words AS bigint) + 32 * cast(shouting AS bigint) AS failed_bits FROM failing)
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars,
       cast(n_symbols AS bigint) AS n_symbols, cast(n_dup_lines AS bigint) AS n_dup_lines,
       cast(n_repeat_words AS bigint) AS n_repeat_words, few OR repeating AS base_failed, failed_bits = 0 AS kept,
       cast(failed_bits AS bigint) AS failed_bits
FROM bits"""


def _level(name: str, groups: str) -> str:
    """Rates of one level shrunk to their parents' rates, by the method of moments."""
    return f"""{name}_groups AS ({groups}),
{name}_prior AS (
  SELECT coalesce(1 / least(greatest(sum(n * power(good / n - parent, 2) - parent * (1 - parent))
                                     / nullif(sum((n - 1) * parent * (1 - parent)), 0), 0.001), 1.0), 1000.0) AS strength
  FROM {name}_groups),
{name}_rates AS (
  SELECT g.*, strength, (strength * parent + good) / (strength + n) AS rate FROM {name}_groups g, {name}_prior)"""


_LISTED = ", ".join(f"'{suffix}'" for suffix in SUFFIXES)


def _named(host: str) -> str:
    """Registered domain and suffix of a host."""
    two = rf"regexp_extract({host}, '([^.]*\.)?[^.]*$')"
    three = rf"regexp_extract({host}, '([^.]*\.)?([^.]*\.)?[^.]*$')"
    return f"""CASE WHEN {two} IN ({_LISTED}) THEN {three} ELSE {two} END AS domain,
         CASE WHEN {two} IN ({_LISTED}) THEN {two} ELSE regexp_extract({host}, '[^.]*$') END AS suffix"""


_SUFFIXES = """SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(rate) AS parent FROM counted, everything GROUP BY suffix"""
_DOMAINS = """SELECT c.suffix, domain, sum(c.n) AS n, sum(c.good) AS good, any_value(rate) AS parent
  FROM counted c JOIN suffix_rates s ON s.suffix = c.suffix GROUP BY c.suffix, domain"""
_HOSTS = """SELECT host, c.n, c.good, rate AS parent FROM counted c JOIN domain_rates d ON d.domain = c.domain"""

#: Rules first, then the upper posterior bound of the host's rate of good pages.
REPUTATION = rf"""WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u, instr(coalesce(url, ''), '://') AS found FROM pages),
split AS (
  SELECT page_id, CASE WHEN found > 0 THEN translate(regexp_extract(substr(u, found + 3), '^([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN found > 0 THEN regexp_extract(substr(u, found + 3), '^([^/?#]*)([^?#]*)', 2) ELSE '' END AS path FROM parts),
outcomes AS (
  SELECT host, cast(quality = 1 AND toxic = 0 AS integer) AS good FROM split JOIN labels ON doc_id = page_id),
counted AS (
  SELECT host, {_named("host")},
         cast(count(*) AS double) AS n, cast(sum(good) AS double) AS good
  FROM outcomes WHERE good IS NOT NULL AND host <> '' GROUP BY host),
everything AS (SELECT (coalesce(sum(good), 0.0) + 1) / (coalesce(sum(n), 0.0) + 2) AS rate FROM counted),
{_level("suffix", _SUFFIXES)},
{_level("domain", _DOMAINS)},
{_level("host", _HOSTS)},
named AS (SELECT page_id, host, path, {_named("host")} FROM split),
rated AS (
  SELECT page_id, s.host, s.path, coalesce(h.rate, d.rate, x.rate, e.rate) AS rate,
         CASE WHEN h.host IS NOT NULL THEN h.strength + h.n WHEN d.domain IS NOT NULL THEN hp.strength
              WHEN x.suffix IS NOT NULL THEN dp.strength ELSE sp.strength END AS total
  FROM named s LEFT JOIN host_rates h ON h.host = s.host LEFT JOIN domain_rates d ON d.domain = s.domain
       LEFT JOIN suffix_rates x ON x.suffix = s.suffix, everything e, host_prior hp, domain_prior dp, suffix_prior sp),
bounds AS (SELECT *, least(rate + 1.645 * sqrt(rate * (1 - rate) / (total + 1)), 1.0) AS bound FROM rated),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting AS (
  SELECT page_id, arg_max(r.verdict, length(rule_host || rule_path)) AS verdict,
         arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
  FROM split s JOIN rules r ON (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)
  GROUP BY page_id)
SELECT b.page_id, b.host, b.path, f.rule,
       coalesce(f.verdict, CASE WHEN b.bound < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM bounds b LEFT JOIN fitting f USING (page_id)"""
