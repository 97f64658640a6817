"""Expected results in DuckDB SQL, stated from the contracts, for the queries that SQL can express."""

from __future__ import annotations

from tradewind.llm.licenses import K, PHRASES, TEMPLATES
from tradewind.llm.urls import ORDER, RULES, STEP

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _blank_words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_filter() -> str:
    """Rules, then interpolated n-gram probabilities, the mean difference of their logarithms, and the calibrated threshold."""
    rules = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, rules)) + " END"

    def log_p(n: str, c: str, t: str) -> str:
        p = "(1.0::DOUBLE / 256)"
        for k in range(1, ORDER + 1):
            p = f"(CASE WHEN {c}{k} > 0 THEN ({n}{k} + {t}{k} * {p}) / ({c}{k} + {t}{k}) ELSE {p} END)"
        return f"ln({p})"

    columns = ", ".join(
        f"coalesce(max({c}) FILTER (k = {k}), 0)::DOUBLE AS {c}{k}" for k in range(1, ORDER + 1) for c in ("na", "nr", "ca", "ta", "cr", "tr")
    )
    return f"""
    WITH cut AS (SELECT row_number() OVER () AS id, page_id, coalesce(url, '') AS url,
            CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT *, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ruled AS (SELECT *, {rule} AS rule, {verdict} AS ruling, ('0x' || substr(md5(url), 1, 8))::UBIGINT % 5 AS fold FROM parts),
    grams AS (SELECT id, ruling, fold, substr(repeat(chr(2), {ORDER - 1}) || url, i, {ORDER}) AS gram FROM ruled, unnest(range(1, length(url) + 1)) t(i)),
    counts AS (SELECT gram, count(*) FILTER (fold <> 0 AND ruling = 'allow') AS a, count(*) FILTER (fold <> 0 AND ruling = 'block') AS r FROM grams GROUP BY gram),
    suffixes AS (SELECT gram, a, r, k, right(gram, k) AS suffix FROM counts, unnest(range(1, {ORDER + 1})) t(k)),
    model AS (SELECT suffix, left(suffix, length(suffix) - 1) AS context, sum(a) AS na, sum(r) AS nr FROM suffixes GROUP BY suffix HAVING sum(a + r) > 0),
    contexts AS (SELECT context, sum(na) AS ca, count(*) FILTER (na > 0) AS ta, sum(nr) AS cr, count(*) FILTER (nr > 0) AS tr FROM model GROUP BY context),
    wide AS (SELECT gram, {columns} FROM suffixes LEFT JOIN (SELECT suffix, na, nr FROM model) USING (suffix)
        LEFT JOIN contexts ON left(suffixes.suffix, length(suffixes.suffix) - 1) = contexts.context GROUP BY gram),
    ratios AS (SELECT gram, {log_p("na", "ca", "ta")} - {log_p("nr", "cr", "tr")} AS ratio FROM wide),
    scored AS (SELECT ruled.*, coalesce(s.score, 0) AS score FROM ruled LEFT JOIN (SELECT id, avg(ratio) AS score FROM grams JOIN ratios USING (gram) GROUP BY id) s USING (id)),
    bins AS (SELECT floor(greatest(-20, least(20, score)) / {STEP}::DOUBLE) AS bin, count(*) FILTER (ruling = 'allow') AS a, count(*) FILTER (ruling = 'block') AS r
        FROM scored WHERE fold = 0 AND ruling IS NOT NULL GROUP BY bin),
    cuts AS (SELECT bin, (SELECT coalesce(sum(a), 0) FROM bins y WHERE y.bin < x.bin) / (SELECT sum(a) FROM bins)
        + (SELECT sum(r) FROM bins y WHERE y.bin >= x.bin) / (SELECT sum(r) FROM bins) AS error FROM bins x
        WHERE (SELECT sum(a) FROM bins) > 0 AND (SELECT sum(r) FROM bins) > 0),
    least AS (SELECT coalesce((SELECT bin * {STEP}::DOUBLE FROM cuts ORDER BY error, abs(bin), bin LIMIT 1), 0) AS least)
    SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) AS score FROM scored, least"""


def repeated_bytes(length: int = 400) -> str:
    """Every window in hexadecimal, counted by its digest; covered stretches united; what is left hashed."""
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS id, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    windows AS (SELECT id, p, md5(substr(h, 2 * p + 1, {2 * length})) AS w FROM docs, unnest(range(0, length(h) // 2 - {length - 1})) t(p)),
    again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    starts AS (SELECT id, p, CASE WHEN p - lag(p) OVER (PARTITION BY id ORDER BY p) <= {length} THEN 0 ELSE 1 END AS new FROM windows JOIN again USING (w)),
    numbered AS (SELECT id, p, sum(new) OVER (PARTITION BY id ORDER BY p) AS span FROM starts),
    spans AS (SELECT id, span, min(p) AS a, max(p) + {length} AS b FROM numbered GROUP BY id, span),
    edges AS (SELECT id, b AS a, lead(a) OVER (PARTITION BY id ORDER BY a) AS b FROM spans
        UNION ALL SELECT id, 0, min(a) FROM spans GROUP BY id),
    kept AS (SELECT e.id, string_agg(substr(h, 2 * e.a + 1, 2 * (coalesce(e.b, length(h) // 2) - e.a)), '' ORDER BY e.a) AS k FROM edges e JOIN docs USING (id) GROUP BY e.id)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce((SELECT CAST(sum(b - a) AS BIGINT) FROM spans WHERE spans.id = docs.id), 0) AS n_removed,
        (SELECT count(*) FROM spans WHERE spans.id = docs.id) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM docs LEFT JOIN kept USING (id)"""


def earlier_passages(length: int = 50) -> str:
    """Every window of words with the least doc_id that has it; words under a window of an earlier document are left out."""
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {_blank_words("text")} AS w FROM documents),
    windows AS (SELECT id, doc_id, p, md5(array_to_string(w[p + 1 : p + {length}], ' ')) AS m FROM docs, unnest(range(0, len(w) - {length - 1})) t(p)),
    firsts AS (SELECT m, min(doc_id) AS least FROM windows GROUP BY m),
    gone AS (SELECT DISTINCT id, p + i AS at FROM windows JOIN firsts USING (m), unnest(range(0, {length})) t(i) WHERE least < doc_id),
    words AS (SELECT id, i AS at, w[i + 1] AS word FROM docs, unnest(range(0, len(w))) t(i)),
    kept AS (SELECT words.id, string_agg(word, ' ' ORDER BY words.at) AS k FROM words ANTI JOIN gone ON words.id = gone.id AND words.at = gone.at GROUP BY words.id)
    SELECT doc_id, len(w) AS n_words, (SELECT count(*) FROM gone WHERE gone.id = docs.id) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (id)"""


def near_copies(percent: int = 85, k: int = 5) -> str:
    """Shared shingles of every pair that shares any; links from the threshold on; the least document that links reach."""
    return f"""
    WITH RECURSIVE docs AS (SELECT doc_id, {_blank_words(_lower("text"))} AS w FROM documents),
    sets AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + {k - 1}], ' ') AS s FROM docs, unnest(range(1, greatest(len(w) - {k - 2}, 2))) t(p) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    found AS (SELECT x, y FROM pairs JOIN sizes m ON x = m.doc_id JOIN sizes n ON y = n.doc_id WHERE 100 * c >= {percent} * (m.n + n.n - c)),
    links AS (SELECT x, y FROM found UNION ALL SELECT y, x FROM found),
    reach AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
    least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id, docs.doc_id = component_id AS kept
    FROM docs LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)"""


def license_scan(least: float = 0.8, slack: int = 3) -> str:
    """All k-grams joined to template positions; votes by diagonal; merged diagonals; spans that cover enough."""
    rows = [(t, x, "TRUE") for t, x in PHRASES.items()] + [(t, x, "FALSE") for t, x in TEMPLATES.items()]
    values = ", ".join(f"({i}, {_quoted(t)}, '{x}', {b})" for i, (t, x, b) in enumerate(rows))
    gram = " || ' ' || ".join(f"w[p + {j}]" for j in range(1, K + 1))
    return f"""
    WITH templates AS (SELECT id, string_split(t, ' ') AS w, label, base FROM (VALUES {values}) v(id, t, label, base)),
    targets AS (SELECT id, label, base, len(w) AS size, p AS t_pos, {gram} AS gram FROM templates, unnest(range(0, len(w) - {K - 1})) t(p)),
    docs AS (SELECT row_number() OVER () AS row, doc_id,
        list_filter(string_split_regex({_lower("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents),
    grams AS (SELECT row, p, {gram} AS gram FROM docs, unnest(range(0, len(w) - {K - 1})) t(p)),
    votes AS (SELECT row, id, label, base, size, p - t_pos AS diagonal, bit_or({(1 << K) - 1}::BIGINT << t_pos::BIGINT) AS bits FROM grams JOIN targets USING (gram) GROUP BY ALL),
    parts AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, id ORDER BY diagonal) > CASE WHEN base THEN 0 ELSE {slack} END THEN 1 ELSE 0 END AS new FROM votes),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY row, id ORDER BY diagonal) AS span FROM parts),
    spans AS (SELECT row, id, label, base, size, span, bit_count(bit_or(bits)) / size::DOUBLE AS share, min(diagonal) AS a, max(diagonal) AS b FROM numbered GROUP BY row, id, label, base, size, span),
    counted AS (SELECT * FROM spans WHERE CASE WHEN base THEN share = 1 ELSE share >= {least} AND b - a <= size / 2.0 END)
    SELECT doc_id, len(any_value(docs.w)) AS n_words, count(*) FILTER (base) AS n_base, CAST(min(a) FILTER (base) AS BIGINT) AS first_word,
        CAST(max(a) FILTER (base) AS BIGINT) AS last_word,
        coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ','), '') AS base_labels,
        coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (label IS NOT NULL))), ','), '') AS labels, coalesce(max(share), 0) AS score
    FROM docs LEFT JOIN counted USING (row) GROUP BY row, doc_id"""


def conversation_repair() -> str:
    """Damage by a CRC stated as SQL, faults by windows, and the cheapest edits row by row for each last role."""
    table = "list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    known = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    key = "lpad(CAST(w.cost + g.cost + f.cost AS VARCHAR), 9, '0') || w.audit || g.audit || f.letter"
    said = "CASE f.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || o.role || ':' || o.text ELSE chr(10) || CASE f.after WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || o.text END"
    space = "\\x20\\x09-\\x0D"
    return f"""
    WITH RECURSIVE crc AS (SELECT {table} AS t),
    keyed AS (SELECT conv_id, turn, {known("role")} AS role, {known("text")} AS text, {known("conv_id")} || ':' || {known("turn")} AS k FROM conversations),
    drawn AS (SELECT keyed.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295) % 20 AS kind FROM keyed, crc),
    hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM drawn, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) t(copy)),
    names AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
    placed AS (SELECT c, turn, role, text, substr(role, 1, 1) AS r, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
        FROM hurt JOIN names ON hurt.conv_id IS NOT DISTINCT FROM names.conv_id),
    judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{space}]') THEN 1 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2
        WHEN regexp_extract(text, '([^{space}])[{space}]*$', 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
        i > 1 AND lag(r) OVER (PARTITION BY c ORDER BY i) || r NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
    one(before, after) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
    gap AS (SELECT before, before AS after, 0 AS cost, '' AS audit, '' AS said FROM one
        UNION ALL SELECT before, after, 2, 'I', CASE after WHEN 2 THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END FROM one
        UNION ALL SELECT a.before, b.after, 4, 'II', CASE a.after WHEN 2 THEN chr(10) || 'user:' || chr(10) || 'assistant:' ELSE chr(10) || 'assistant:' || chr(10) || 'user:' END
            FROM one a JOIN one b ON a.after = b.before),
    fate AS (SELECT before, after, 'R' AS letter, CAST(NULL AS VARCHAR) AS r, 2 AS cost FROM one
        UNION ALL SELECT before, before, 'D', CAST(NULL AS VARCHAR), 3 FROM one
        UNION ALL SELECT * FROM (VALUES (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0)) k),
    walk AS (SELECT c, CAST(0 AS BIGINT) AS i, 0 AS state, 0 AS cost, '' AS audit, '' AS said FROM names
        UNION ALL
        SELECT c, i, state, CAST(substr(least, 1, 9) AS INTEGER), substr(least, 10), said FROM (
            SELECT w.c, w.i + 1 AS i, f.after AS state, min({key}) AS least, arg_min(w.said || g.said || {said}, {key}) AS said
            FROM walk w JOIN gap g ON g.before = w.state JOIN judged o ON o.c = w.c AND o.i = w.i + 1
            JOIN (SELECT fate.*, bad FROM fate, (VALUES (FALSE), (TRUE)) b(bad)) f0 ON f0.before = g.after AND (f0.r IS NULL OR f0.r = o.r)
                AND (f0.letter = 'D' OR o.fault NOT IN (1, 2)) AND f0.bad = (o.fault = 3),
            LATERAL (SELECT f0.after, f0.letter, f0.cost + CASE WHEN f0.bad AND f0.letter <> 'D' THEN 1 ELSE 0 END AS cost) f
            GROUP BY w.c, w.i, f.after)),
    sizes AS (SELECT c, count(i) AS n FROM names LEFT JOIN judged USING (c) GROUP BY c),
    ends AS (SELECT w.c, min(lpad(CAST(w.cost + g.cost AS VARCHAR), 9, '0') || w.audit || g.audit) AS least,
        arg_min(w.said || g.said, lpad(CAST(w.cost + g.cost AS VARCHAR), 9, '0') || w.audit || g.audit) AS said
        FROM walk w JOIN sizes ON sizes.c = w.c AND sizes.n = w.i JOIN gap g ON g.before = w.state WHERE g.after IN (0, 3) GROUP BY w.c),
    counted AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
        count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal FROM judged GROUP BY c)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, CAST(substr(least, 1, 9) AS BIGINT) AS cost, substr(least, 10) AS audit, sha256(substr(said, 2)) AS repaired_sha256
    FROM names JOIN ends USING (c) LEFT JOIN counted USING (c)"""


def fill_in_middle() -> str:
    """Tokens as a list, cut by the numbers of the digest; what comes back must be the text."""
    number = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS UBIGINT)"
    part = lambda a, b: f"coalesce(array_to_string(u[{a} : {b}], ''), '')"
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    drawn AS (SELECT *, len(u) AS n, CAST({number(0)} % (len(u) + 1) AS BIGINT) AS x, CAST({number(1)} % (len(u) + 1) AS BIGINT) AS y FROM docs),
    cut AS (SELECT doc_id, n, t, {part("1", "least(x, y)")} AS p, {part("least(x, y) + 1", "greatest(x, y)")} AS m, {part("greatest(x, y) + 1", "n")} AS s,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {number(2)} % 100 >= 90 THEN 'plain'
            WHEN {number(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM cut"""


EXPECTED = {
    "op1_url_filter": url_filter(),
    "op5_suffix_array_dedup": repeated_bytes(),
    "op6_substring_dedup": earlier_passages(),
    "op9_minhash_near_dedup": near_copies(),
    "op10_license_scan": license_scan(),
    "op12_conversation_repair": conversation_repair(),
    "op13_fill_in_middle": fill_in_middle(),
}
