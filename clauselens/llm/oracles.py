"""DuckDB SQL with the expected result of the queries that SQL can express."""

from __future__ import annotations

from clauselens.llm import divergence, minhash_join, mixing, pii, prefix_trie, quality_rules, secret_scan, sharding, suffix_dedup, url_filter
from clauselens.llm import decontaminate as decon

UPPER, LOWER = url_filter.UPPER, url_filter.LOWER
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def folded_words(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), '{TERM}')"


def mixing_sql() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    n, k, quantum = len(mixing.WEIGHTS), mixing.MOST_PASSES, mixing.QUANTUM
    return f"""WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size, md5('0' || chr(31) || doc_id) AS key FROM documents),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key) - size AS start FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, {k} * sum(size)::BIGINT AS lim,
  [{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n} + 1] AS weight FROM d GROUP BY source),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM s),
f AS (SELECT *, rest * weight >= lim * weights AS is_full FROM o),
l AS (SELECT arg_min(rest, lim / weight) AS rest, arg_min(weights, lim / weight) AS weights FROM f WHERE NOT is_full),
t AS (SELECT f.source, source_size, CASE WHEN is_full THEN lim::DOUBLE
  ELSE (weight * l.rest)::DOUBLE / l.weights::DOUBLE END AS target FROM f LEFT JOIN l ON TRUE),
placed AS (SELECT doc_id, q.source, size, source_size, target, start FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
passes AS (SELECT *, unnest(range({k})) AS pass FROM placed WHERE size > 0 AND target > 0),
packets AS (SELECT *, unnest(range((size + {quantum - 1}) // {quantum})) AS nth FROM passes),
sized AS (SELECT *, least((nth + 1) * {quantum}, size) - nth * {quantum} AS words,
  (pass * source_size + start + least((nth + 1) * {quantum}, size))::DOUBLE / target AS finish FROM packets),
total AS (SELECT sum(size) AS budget FROM d),
run AS (SELECT *, sum(words) OVER (ORDER BY finish, source NULLS FIRST, start, pass, nth ROWS UNBOUNDED PRECEDING) AS running FROM sized),
served AS (SELECT doc_id, sum(least(words, greatest(0, budget - (running - words)))) AS taken FROM run, total GROUP BY doc_id)
SELECT doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN served USING (doc_id)"""


def dedup_sql() -> str:
    w = suffix_dedup.WIDTH
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, h, unnest(range(n - {w} + 1)) AS i FROM d WHERE n >= {w}),
x AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * w}) AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM x GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM x JOIN m USING (s) WHERE least < doc_id),
r AS (SELECT doc_id, i, sum(CASE WHEN gap <= {w} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
spans AS (SELECT doc_id, run, min(i) AS b, max(i) + {w} AS e FROM r GROUP BY doc_id, run),
cut AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before FROM spans),
kept AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
  string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS head FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def join_sql() -> str:
    k = minhash_join.SHINGLE
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {folded_words('text')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 9 * shared >= 4 * (x.n + y.n)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a), k AS (SELECT a, count(*) AS links FROM l GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(least, doc_id)) AS class_id, coalesce(links, 0) AS n_links
FROM d LEFT JOIN m ON m.a = doc_id LEFT JOIN k ON k.a = doc_id"""


def decontamination_sql() -> str:
    w = decon.WIDTH
    return f"""WITH items AS (SELECT item_id, {folded_words('text')} AS w FROM benchmark),
wide AS (SELECT item_id, w, len(w) AS n, least({w}, len(w)) AS size FROM items WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, n - size + 2)) AS i FROM wide)),
d AS (SELECT doc_id, {folded_words('text')} AS w FROM documents),
o AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM win))),
h AS (SELECT doc_id, i, size, item_id FROM o JOIN win USING (size, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""


def url_sql() -> str:
    longest = sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in longest]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, longest)) + " END"
    ruled = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, longest)) + " END"
    order, scale = url_filter.ORDER, url_filter.SCALE
    held = ", ".join(f"'{c}'" for c in url_filter.HELD_OUT)
    tables = [f"""g{order} AS (SELECT g, {', '.join(f"sum(CASE WHEN label = '{v}' AND NOT held THEN n ELSE 0 END) AS {v}" for v in url_filter.VERDICTS)}
  FROM grams JOIN u USING (t) GROUP BY g)"""]
    tables += [f"g{k} AS (SELECT g[2:] AS g, sum(allow) AS allow, sum(block) AS block FROM g{k + 1} GROUP BY 1)" for k in range(order - 1, -1, -1)]
    for k in range(order + 1):
        over = f"PARTITION BY g[1:{k}]" if k else ""
        stats = ", ".join(f"sum({v}) OVER ({over}) AS t_{v}, count(*) FILTER (WHERE {v} > 0) OVER ({over}) AS k_{v}" for v in url_filter.VERDICTS)
        shares = ", ".join(f"CASE WHEN t_{v} > 0 THEN (x.{v} + k_{v} * {less}) / (t_{v} + k_{v})::DOUBLE ELSE {less} END AS p_{v}" for v, less in (
            (v, f"y.p_{v}" if k else f"{url_filter.UNSEEN!r}::DOUBLE") for v in url_filter.VERDICTS))
        tables.append(f"s{k} AS (SELECT x.g, {shares} FROM (SELECT *, {stats} FROM g{k}) x" + (f" JOIN s{k - 1} y ON y.g = x.g[2:])" if k else ")"))

    def moments(v: str) -> str:
        own = f"FILTER (WHERE held AND label = '{v}')"
        mean = f"sum(n * milli) {own}::DOUBLE / sum(n) {own}::DOUBLE"
        square = f"sum(n * milli * milli) {own}::DOUBLE / sum(n) {own}::DOUBLE"
        return f"{mean} AS m_{v}, sqrt(greatest({square} - ({mean}) * ({mean}), 0.0)) + 1 AS d_{v}"

    return rf"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
spelled AS (SELECT page_id, host, path, {rule} AS rule, {ruled} AS ruled, repeat(chr({ord(url_filter.START)}), {order}) || host || path || chr({ord(url_filter.END)}) AS t FROM p),
u AS (SELECT t, any_value(ruled) AS label, count(*) AS n, md5(t)[1] IN ({held}) AS held FROM spelled GROUP BY t),
grams AS (SELECT t, substr(t, i, {order + 1}) AS g FROM (SELECT t, unnest(range(1, length(t) - {order - 1})) AS i FROM u)),
{', '.join(tables)},
diffs AS (SELECT g, round((ln(p_allow) - ln(p_block)) * {scale})::BIGINT AS diff FROM s{order}),
scored AS (SELECT t, sum(diff)::DOUBLE / count(*)::DOUBLE AS score FROM grams JOIN diffs USING (g) GROUP BY t),
m AS (SELECT *, round(score / {scale // 1000})::BIGINT AS milli FROM scored JOIN u USING (t)),
stats AS (SELECT {moments('allow')}, {moments('block')} FROM m),
lim AS (SELECT round((m_allow * d_block + m_block * d_allow) / (d_allow + d_block) * {scale // 1000}) AS lim FROM stats)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score < lim THEN 'block' END, 'allow') AS verdict
FROM spelled JOIN scored USING (t) CROSS JOIN lim"""


def sharding_sql(names: list[str]) -> str:
    owners = ", ".join(map(str, sharding.fill_table(names)))
    shards = ", ".join(map(text, names))
    return f"""WITH t AS (SELECT [{owners}] AS owners, [{shards}] AS names),
d AS (SELECT doc_id, source, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS})::INTEGER AS slot FROM documents)
SELECT doc_id, source, slot, names[owners[slot + 1] + 1] AS shard FROM d, t"""


def rules_sql() -> str:
    def any_of(words: list[str]) -> str:
        return "|".join(w.replace("'", "''") for w in words)

    rules = quality_rules
    separator = rf"(?:^|{SPACE})(?:\||>|»|›|•|·)(?:{SPACE}|$)"
    marks = f"len(regexp_extract_all(line, '{separator}'))"
    symbols = "len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]$')))"
    wording = f"len(regexp_extract_all(array_to_string(regexp_extract_all(line, '(?i){any_of(rules.BOILERPLATE)}'), ' '), '{WORD}'))"
    closers = rules.CLOSERS.replace("'", "''").replace("]", "\\]")
    ends = f"regexp_matches(line, '[{rules.END_MARKS}][{closers}]*{SPACE}*$')"
    capitals = "len(list_filter(w, lambda x: regexp_matches(x, '^\\p{Lu}')))"
    fails = rf"""({marks} >= 2 AND 4 * {marks} >= len(w)) OR regexp_full_match(line, '(?i)\W*(?:(?:{any_of(rules.NAVIGATION)})\b\W*){{2,}}')
    OR 2 * {symbols} > len(w) OR ({wording} > 0 AND {wording} >= {rules.NOTICE_SHARE}::DOUBLE * len(w))
    OR (NOT {ends} AND (len(w) < {rules.SHORT} OR (len(w) >= {rules.LEAST_CAPITALS} AND {capitals} >= {rules.CAPITALS}::DOUBLE * len(w))))"""
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
lines AS (SELECT doc_id, line, regexp_extract_all(line, '{WORD}') AS w FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (SELECT doc_id, line, strlen(array_to_string(w, '')) AS size, ({fails}) AS fails FROM lines WHERE len(w) > 0),
per AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, count(*) FILTER (WHERE fails) AS failed,
  coalesce(sum(size) FILTER (WHERE fails), 0) AS lost, sum(size) AS held FROM judged GROUP BY doc_id),
win AS (SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM win JOIN (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  coalesce(failed, 0) AS n_failed_lines, coalesce(lost, 0) AS lost, coalesce(held, 0) AS held
  FROM d LEFT JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT * EXCLUDE (lost, held), NOT base_failed AND lost::DOUBLE <= {quality_rules.MAX_LOSS}::DOUBLE * held::DOUBLE AS kept FROM b"""


# fixed values: the base patterns as they are stated, without the possessive forms that RE2 does not know
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLAIN_TERM = r"[\p{L}\p{N}]+(?:[-_.''][\p{L}\p{N}]+)*"


def located(pattern: str, source: str, columns: str) -> str:
    """(columns, value, start, finish) of all matches in the lines of a table, in code points of the document."""
    return f"""SELECT {columns}, value, off + sum(gap + len(value)) OVER (PARTITION BY {columns} ORDER BY nth) - len(value) AS start,
  off + sum(gap + len(value)) OVER (PARTITION BY {columns} ORDER BY nth) AS finish
FROM (SELECT {columns}, off, unnest(found) AS value, unnest(range(len(found))) AS nth,
  unnest(list_transform(pieces[:len(found)], lambda p: len(p))) AS gap
  FROM (SELECT *, regexp_extract_all(line, '{pattern}') AS found, string_split_regex(line, '{pattern}') AS pieces FROM {source})
  WHERE len(found) > 0)"""


def pii_sql() -> str:
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    doubled = "list_transform(string_split(reverse(d), ''), lambda x, i: CASE WHEN i % 2 = 1 THEN x::INT WHEN x::INT > 4 THEN x::INT * 2 - 9 ELSE x::INT * 2 END)"
    valid = {
        "email": "TRUE", "ip": f"regexp_full_match(value, '{pii.OCTET}(?:\\.{pii.OCTET}){{3}}')",
        "card": f"len(d) BETWEEN 12 AND 19 AND list_sum({doubled}) % 10 = 0", "phone": "len(d) BETWEEN 9 AND 15",
    }
    found = " UNION ALL ".join(
        f"SELECT doc_id, nr, '{k}' AS kind, {i} AS rank, value, start, finish FROM (SELECT *, {digits} AS d FROM ({located(p, 'lines', 'doc_id, nr')})) WHERE {valid[k]}"
        for i, (k, p) in enumerate(PLAIN.items()))
    order = "string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank, finish)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in PLAIN)
    shown = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in PLAIN)
    return f"""WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
cells AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS nr FROM raw),
lines AS (SELECT *, coalesce(sum(len(line) + 1) OVER (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM cells),
base AS ({found}),
names AS (SELECT DISTINCT doc_id, nr, kind || ':' || lower(value) AS name FROM base),
total AS (SELECT count(*) AS n FROM lines WHERE regexp_matches(line, '{WORD}')),
entity AS (SELECT name, count(*) AS n_entity FROM names GROUP BY name),
held AS (SELECT * FROM lines WHERE (doc_id, nr) IN (SELECT doc_id, nr FROM names)),
near AS ({located(PLAIN_TERM, 'held', 'doc_id, nr')}),
said AS (SELECT DISTINCT name, doc_id, nr, lower(value) AS term FROM near JOIN names USING (doc_id, nr) WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = near.doc_id AND b.kind || ':' || lower(b.value) = name AND b.start < near.finish AND near.start < b.finish)),
pairs AS (SELECT name, term, count(*) AS n_both FROM said GROUP BY name, term),
terms AS (SELECT term, count(*) AS n_term FROM (SELECT unnest(list_distinct(list_transform(
  regexp_extract_all(line, '{PLAIN_TERM}'), lambda x: lower(x)))) AS term FROM lines) WHERE term IN (SELECT term FROM pairs) GROUP BY term),
scored AS (SELECT name, term, n, n_entity, log2((n * n_both / n_entity::DOUBLE + {pii.SHRINK}) / (n_term + {pii.SHRINK})::DOUBLE) AS bits
  FROM pairs JOIN terms USING (term) JOIN entity USING (name), total WHERE n_entity * {2**pii.MIN_BITS} <= n),
rated AS (SELECT name, term, round(bits / log2(n::DOUBLE / n_entity::DOUBLE), 9) AS reveals FROM scored WHERE round(bits, 9) >= {pii.MIN_BITS}),
marked AS (SELECT doc_id, term, max(CASE WHEN reveals >= {pii.REMOVE} THEN 'remove' ELSE 'generalise' END) AS kind
  FROM (SELECT DISTINCT doc_id, name FROM names) JOIN rated USING (name) WHERE reveals >= {pii.GENERALISE} GROUP BY doc_id, term),
own AS (SELECT * FROM lines WHERE doc_id IN (SELECT doc_id FROM marked)),
words AS ({located(PLAIN_TERM, 'own', 'doc_id, nr')}),
added AS (SELECT words.doc_id, words.nr, kind, CASE kind WHEN 'remove' THEN 5 ELSE 4 END AS rank, value, start, finish
  FROM words JOIN marked ON marked.doc_id = words.doc_id AND term = lower(value)
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = words.doc_id AND b.start < words.finish AND words.start < b.finish)),
b AS (SELECT doc_id, {counts}, {order} AS base FROM base GROUP BY doc_id),
s AS (SELECT doc_id, {order} AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY doc_id)
SELECT raw.doc_id, {shown}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM raw LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)"""


def secrets_sql() -> str:
    rules = secret_scan.RULES
    found = " UNION ALL ".join(
        f"""SELECT doc_id, copy, '{r.kind}' AS kind, {i} AS rank, start, finish FROM ({located(r.pattern.replace("'", "''"), 'docs', 'doc_id, copy')})
  WHERE length(regexp_extract(value, '{r.pattern.replace("'", "''")}', {r.group})) >= {r.least}""" for i, r in enumerate(rules))
    base = [r.kind for r in rules if r.base]
    order = "string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in base)
    shown = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in base)
    named = ", ".join(f"'{k}'" for k in base)
    return f"""WITH docs AS (SELECT doc_id, row_number() OVER () AS copy, coalesce(text, '') AS line, 0 AS off FROM documents),
hits AS ({found}),
s AS (SELECT copy, {counts}, {order} FILTER (WHERE kind IN ({named})) AS base, {order} AS spans FROM hits GROUP BY copy)
SELECT doc_id, {shown}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN s USING (copy)"""


def divergence_sql() -> str:
    upper = "".join(map(chr, range(65, 91)))

    def share(n: str, total: str, kept: str) -> str:
        return f"1 + ({divergence.SCALE}::HUGEINT * ({n} + 2)) // ({total} + 2 * {kept})"

    def difference(p: str, q: str) -> str:
        return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"

    terms = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(t, '{upper}', '{upper.lower()}'), '{terms}')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(any_value(t.total), 0) AS total FROM d LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) t
  ON t.lang = d.lang AND t.source = d.source GROUP BY d.lang, d.source),
x AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, {share('coalesce(c.n, 0)', 'g.total', 'v.kept')} AS p, {share('kept.n', 'v.total', 'v.kept')} AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (SELECT y.lang, y.source, z.source AS item, sum({difference('y.p', 'z.p')}) AS value FROM x y JOIN x z ON z.lang = y.lang AND z.term = y.term
    AND z.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ({difference('p', 'q')})::BIGINT AS value FROM x WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def trie_sql() -> str:
    f, m = prefix_trie.FAMILY, prefix_trie.MOST_SHARED
    # the checksum bit by bit: reversed polynomial, all bits set before, inverted after
    return f"""WITH RECURSIVE ids AS (SELECT DISTINCT conv_id::BIGINT AS c FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT c, c::VARCHAR AS s, 0 AS pos, 4294967295::BIGINT AS r FROM ids UNION ALL
  SELECT c, s, pos + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT c, s, pos, CASE WHEN pos % 8 = 0 THEN xor(r, ascii(s[pos // 8 + 1])::BIGINT) ELSE r END AS x FROM bits WHERE pos < 8 * len(s))),
heads AS (SELECT c, (xor(r, 4294967295) % {m})::INTEGER AS h, c - c % {f} AS head FROM bits WHERE pos = 8 * len(s)),
t AS (SELECT conv_id::BIGINT AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS i FROM conversations WHERE conv_id IS NOT NULL),
joined AS (SELECT heads.c, 0 AS part, i, role, text, d FROM heads JOIN t ON t.c = head WHERE i <= h
  UNION ALL SELECT heads.c, 1, i, role, text, d FROM heads JOIN t ON t.c = heads.c WHERE i > h),
placed AS (SELECT c, role, text, d, row_number() OVER (PARTITION BY c ORDER BY part, i) AS i FROM joined),
walks AS (SELECT c, list(d ORDER BY i) AS w, list(strlen(text) ORDER BY i) AS sizes FROM placed GROUP BY c),
whole AS (SELECT c, coalesce(w, []) AS w, sizes FROM ids LEFT JOIN walks USING (c)),
steps AS (SELECT c, w, k AS depth, w[1:k] AS p, CASE WHEN k = 0 THEN 0 ELSE sizes[k] END AS size FROM (SELECT *, unnest(range(len(w) + 1)) AS k FROM whole)),
n AS (SELECT p, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
  coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(w) = depth), '') AS ends FROM steps GROUP BY p, depth),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (p)),
up AS (SELECT u.p[1:g] AS p, (u.n_children = 0)::INTEGER AS leaf, (u.n_convs - 1) * u.size AS saving FROM (SELECT *, unnest(range(depth + 1)) AS g FROM k) u),
sums AS (SELECT p, sum(leaf)::BIGINT AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM up GROUP BY p)
SELECT k.conv_id, k.depth, a.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(k.ends) AS ends_sha256
FROM k JOIN sums ON sums.p = k.p LEFT JOIN n a ON k.depth > 0 AND a.p = k.p[1:k.depth - 1]"""
