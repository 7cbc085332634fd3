"""SQL with the same results, where SQL can express the query."""

from __future__ import annotations

from starlift.llm.sentences import SENTENCE, WORD, Spans
from starlift.llm.url_filter import ADDRESS, DEVIATIONS, FALL, RULES, STEPS, STRONGEST, SUFFIX, WEAKEST, Filter
from starlift.llm.vector_codes import Quantizer

_SPACE_CLASS = r"[ \t\n\x0b\f\r]"


def _warc() -> str:
    return """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    copied AS (
        SELECT payload, max(page_id) AS original FROM payloads
        WHERE strlen(payload) >= 1000 GROUP BY payload HAVING count(*) > 1
    )
    SELECT page_id, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS payload_digest,
        CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN original IS NOT NULL AND page_id IS DISTINCT FROM original THEN original END AS refers_to
    FROM payloads p LEFT JOIN copied c ON p.payload = c.payload"""


def _url_filter() -> str:
    setting = Filter()
    rules = ", ".join(f"('{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{verdict}')" for rule, verdict in RULES)

    def strength(level: str, mean: str) -> str:
        rate = f"(bad / n - {mean})"
        excess = f"sum(n * {rate} * {rate} - {mean} * (1 - {mean}))"
        room = f"sum((n - 1) * {mean} * (1 - {mean}))"
        return f"""SELECT CASE WHEN coalesce({room}, 0) = 0 THEN {WEAKEST} WHEN {excess} <= 0 THEN {STRONGEST}
            ELSE least({STRONGEST}, greatest({WEAKEST}, {room} / {excess} - 1)) END AS s FROM {level} WHERE n > 0"""

    def area(low: str, high: str) -> str:
        # Simpson's rule over the log odds u of the beta density.
        u, step = f"({low} + ({high} - {low}) / {STEPS} * k)", f"(({high} - {low}) / {STEPS})"
        height = "((a + b) * (least({0}, 0) - ln(1 + exp(-abs({0})))) - b * {0})"
        times = f"CASE WHEN k IN (0, {STEPS}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
        return f"{step} * list_sum([{times} * exp({height.format(u)} - {height.format('mode')}) for k in range({STEPS + 1})])"

    return f"""
    WITH urls AS (
        SELECT page_id, url,
            coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ),
    parts AS (SELECT *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '\\.?(?::[0-9]*)?\\z', '') AS name FROM urls),
    worth AS (SELECT doc_id, avg(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    outcomes AS (
        SELECT name, CASE WHEN quality < 0.5 THEN 1.0 ELSE 0.0 END AS bad
        FROM parts JOIN worth ON try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS BIGINT) = doc_id
    ),
    counted AS (
        SELECT name, count(o.bad)::DOUBLE AS n, coalesce(sum(o.bad), 0.0)::DOUBLE AS bad,
            regexp_matches(name, '{ADDRESS}') AS address, regexp_extract(name, '{SUFFIX}', 1) AS ending
        FROM (SELECT DISTINCT name FROM parts) h LEFT JOIN outcomes o USING (name) GROUP BY name
    ),
    hosts AS (
        SELECT name, n, bad, CASE WHEN address THEN '.' ELSE ending END AS suffix,
            CASE WHEN address OR name = ending THEN name
                ELSE string_split(substr(name, 1, length(name) - length(ending) - 1), '.')[-1] || '.' || ending END AS domain
        FROM counted
    ),
    corpus AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM hosts),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS mean FROM hosts, corpus GROUP BY suffix),
    s1 AS ({strength("suffixes", "mean")}),
    domains AS (
        SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.bad) AS bad, any_value((x.bad + s * x.mean) / (x.n + s)) AS mean
        FROM hosts h JOIN suffixes x USING (suffix), s1 GROUP BY h.suffix, h.domain
    ),
    s2 AS ({strength("domains", "mean")}),
    rated AS (
        SELECT h.name, h.n, h.bad, (d.bad + s * d.mean) / (d.n + s) AS mean
        FROM hosts h JOIN domains d USING (suffix, domain), s2
    ),
    s3 AS ({strength("rated", "mean")}),
    posterior AS (SELECT name, bad + s * mean AS a, n - bad + s * (1 - mean) AS b FROM rated, s3),
    peaks AS (SELECT *, ln(a / b) AS mode, sqrt((a + b) / (a * b)) AS deviation FROM posterior),
    ends AS (SELECT *, mode - {DEVIATIONS} * deviation - {FALL} / a AS low, mode + {DEVIATIONS} * deviation + {FALL} / b AS high FROM peaks),
    middles AS (SELECT *, least(high, greatest(low, ln({setting.max_bad} / (1 - {setting.max_bad})))) AS middle FROM ends),
    areas AS (SELECT name, {area("low", "middle")} AS below, {area("middle", "high")} AS above FROM middles),
    rules(rule, rule_host, rule_path, decision) AS (VALUES {rules}),
    fits AS (
        SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(decision, length(rule)) AS decision
        FROM (SELECT DISTINCT host, path FROM parts)
        JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path
    )
    SELECT page_id, p.host, p.path, rule,
        coalesce(decision, CASE WHEN below / (below + above) < {setting.doubt} THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts p JOIN areas b ON p.name = b.name LEFT JOIN fits f ON p.host = f.host AND p.path = f.path"""


def _decontaminate() -> str:
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    phrase = "array_to_string(list_slice(words, pos, pos + size - 1), ' ')"
    return f"""
    WITH items AS MATERIALIZED (
        SELECT row_number() OVER () AS entry, coalesce(item_id::VARCHAR, '') AS item, words, least(10, len(words)) AS size
        FROM (SELECT item_id, {words} AS words FROM benchmark) WHERE len(words) > 0
    ),
    windows AS (
        SELECT DISTINCT item, size, {phrase} AS phrase
        FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS pos FROM items)
    ),
    docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {words} AS words FROM documents),
    sizes AS (SELECT DISTINCT size FROM windows),
    starts AS (
        SELECT row, size, pos, {phrase} AS phrase
        FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM docs, sizes WHERE len(words) >= size)
    ),
    met AS (SELECT row, item, pos, s.size FROM starts s JOIN windows w ON s.size = w.size AND s.phrase = w.phrase),
    hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(pos, pos + size)) AS place FROM met) GROUP BY row),
    named AS (SELECT row, list_sort(list(DISTINCT item)) AS items FROM met GROUP BY row),
    places AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS pos FROM docs),
    terms AS (SELECT entry, size, unnest(words) AS word, unnest(range(len(words))) AS n FROM items),
    cells AS (
        SELECT DISTINCT row, entry, size, n, pos - n + off AS line
        FROM places JOIN terms USING (word), (VALUES (-1), (0), (1)) o(off)
    ),
    dense AS (SELECT *, count(*) OVER (PARTITION BY row, entry, line ORDER BY n RANGE BETWEEN CURRENT ROW AND 9 FOLLOWING) AS met FROM cells),
    near AS (
        SELECT row, list_sort(list(DISTINCT item)) AS near_items
        FROM (SELECT DISTINCT row, entry FROM dense WHERE met >= size) JOIN items USING (entry)
        WHERE (row, item) NOT IN (SELECT row, item FROM met) GROUP BY row
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
        sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
        coalesce(len(near_items), 0)::BIGINT AS n_near, sha256(coalesce(array_to_string(near_items, ','), '')) AS near_sha256
    FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row) LEFT JOIN near USING (row)"""


def _sentences() -> str:
    spans = Spans()
    k = spans.run
    key = f"trim(regexp_replace(unit, '{_SPACE_CLASS}+', ' ', 'g'))"
    span = " || chr(10) || ".join(f"keys[pos + {n}]" for n in range(k))
    around = "coalesce(min(h) OVER (PARTITION BY row, n ORDER BY pos ROWS BETWEEN {}), 'g')"
    before, after = around.format(f"{spans.radius} PRECEDING AND 1 PRECEDING"), around.format(f"1 FOLLOWING AND {spans.radius} FOLLOWING")
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS text_key,
            regexp_extract_all(regexp_replace(coalesce(text, ''), '^{_SPACE_CLASS}+', ''), '{SENTENCE}') AS sentences
        FROM documents
    ),
    numbered AS (SELECT row, unnest(sentences) AS sentence, unnest(range(len(sentences))) AS n FROM docs),
    worded AS MATERIALIZED (SELECT *, regexp_extract_all(sentence, '{WORD}') AS words FROM numbered),
    words AS (
        SELECT row, n, word, pos, substr(md5(regexp_replace(word, '{_SPACE_CLASS}+$', '')), 1, 8) AS h
        FROM (SELECT row, n, unnest(words) AS word, unnest(range(len(words))) AS pos FROM worded WHERE len(words) > {spans.longest})
    ),
    marked AS (SELECT *, (h < {before} AND h <= {after})::INTEGER AS cut FROM words),
    pieces AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY row, n ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM marked),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY row, n, piece ORDER BY pos) - 1) // {spans.most} AS part FROM pieces),
    cut AS (
        SELECT row, n, 0 AS piece, 0 AS part, sentence AS unit FROM worded WHERE len(words) <= {spans.longest}
        UNION ALL SELECT row, n, piece, part, string_agg(word, '' ORDER BY pos) FROM placed GROUP BY row, n, piece, part
    ),
    texts AS MATERIALIZED (
        SELECT row, list(unit ORDER BY n, piece, part) AS units, list({key} ORDER BY n, piece, part) AS keys FROM cut GROUP BY row
    ),
    runs AS (
        SELECT row, pos, {span} AS span
        FROM (SELECT row, keys, unnest(range(1, len(keys) - {k} + 2)) AS pos FROM texts)
    ),
    later AS (
        SELECT row, pos FROM (
            SELECT row, pos, row_number() OVER (PARTITION BY span ORDER BY doc_id NULLS LAST, pos, text_key, row) AS place
            FROM runs JOIN docs USING (row)
        ) WHERE place > 1
    ),
    gone AS (SELECT row, list(DISTINCT place) AS places FROM (SELECT row, unnest(range(pos, pos + {k})) AS place FROM later) GROUP BY row)
    SELECT d.doc_id, coalesce(len(units), 0)::BIGINT AS n_sentences, coalesce(len(places), 0)::BIGINT AS n_removed,
        coalesce(array_to_string([units[p] FOR p IN range(1, len(units) + 1)
            IF NOT list_contains(coalesce(places, []), p)], ''), '') AS text
    FROM docs d LEFT JOIN texts t USING (row) LEFT JOIN gone USING (row)"""


def _vector_codes() -> str:
    bad = "x IS NULL OR NOT isfinite(x)"
    apart = "list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT"
    floored = "((s - ((s % n) + n) % n) // n)"  # of whole numbers, down also where s is negative
    rounds = []
    for k in range(Quantizer.rounds + 1):
        rounds.append(f"""a{k} AS MATERIALIZED (
            SELECT p.row, p.part, min({apart} * {Quantizer.entries} + entry) AS found
            FROM parts p JOIN c{k} c ON p.part = c.part GROUP BY p.row, p.part
        )""")
        if k < Quantizer.rounds:
            rounds.append(f"""c{k + 1} AS MATERIALIZED (
                SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
                    SELECT part, entry, list({floored} ORDER BY axis) AS x FROM (
                        SELECT part, found % {Quantizer.entries} AS entry, axis, sum(x[axis])::BIGINT AS s, count(*) AS n
                        FROM a{k} JOIN parts USING (row, part), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS axis)
                        GROUP BY ALL
                    ) GROUP BY part, entry
                ) m ON c.part = m.part AND c.entry = m.entry
            )""")
    last = Quantizer.rounds
    return f"""
    WITH finite AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({Quantizer.scale} * x::DOUBLE)::BIGINT) AS v,
            row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: {bad})) = 0
    ),
    kept AS MATERIALIZED (SELECT * FROM finite WHERE len(v) = (SELECT len(v) FROM finite WHERE row = 1)),
    parts AS MATERIALIZED (
        SELECT row, part, v[part * len(v) // {Quantizer.parts} + 1 : (part + 1) * len(v) // {Quantizer.parts}] AS x
        FROM kept, (SELECT unnest(range({Quantizer.parts})) AS part)
    ),
    c0 AS MATERIALIZED (
        SELECT part, dense_rank() OVER (ORDER BY row) - 1 AS entry, x FROM parts
        WHERE row IN (SELECT row FROM kept ORDER BY row LIMIT {Quantizer.entries})
    ),
    {", ".join(rounds)},
    coded AS MATERIALIZED (
        SELECT row, string_agg(printf('%02x', found % {Quantizer.entries}), '' ORDER BY part) AS code,
            sum(found // {Quantizer.entries})::BIGINT AS error
        FROM a{last} GROUP BY row
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
        (SELECT sha256(coalesce(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry), '')) FROM c{last}) AS codebooks_sha256
    FROM kept JOIN coded USING (row)"""


def _neighbours() -> str:
    bad = "x IS NULL OR NOT isfinite(x)"
    return f"""
    WITH usable AS (
        SELECT vec_id, embedding::DOUBLE[] AS x, row_number() OVER () AS row FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: {bad})) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    kept AS MATERIALIZED (
        SELECT * FROM usable WHERE len(x) = (SELECT len(x) FROM usable GROUP BY len(x) ORDER BY count(*) DESC, len(x) LIMIT 1)
    ),
    ranked AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x) AS score,
            row_number() OVER (PARTITION BY q.row ORDER BY list_dot_product(q.x, v.x) DESC, v.vec_id NULLS LAST)::INTEGER AS rank
        FROM kept q JOIN kept v ON q.vec_id % 20 = 0 AND q.row <> v.row
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


def _manifest() -> str:
    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def leaf(length: str) -> str:
        return f"sha256({' || '.join(field(name) for name in ('doc_id', 'source', 'lang', length, 'text'))})"

    one_bit = "lambda c, _: xor(c >> 1, 3988292384 * (c & 1))"  # the polynomial of CRC-32, low bit first
    one_byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {one_bit})"
    octets = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc32 = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {one_byte}), 4294967295)"

    def levels(name: str, start: str) -> str:
        pairs = "list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))"
        return f"""{name} AS (
            SELECT tree, 0 AS level, nodes FROM ({start})
            UNION ALL SELECT tree, level + 1, {pairs} FROM {name} WHERE len(nodes) > 1
        )"""

    def path(rows: str, name: str) -> str:
        """The siblings of each leaf of a tree, from the lowest level on."""
        sibling = "coalesce(nodes[xor(place >> level, 1) + 1], '')"
        left = "(place >> level) & 1 = 1"
        step = f"{{'left': CASE WHEN {left} THEN {sibling} ELSE '' END, 'right': CASE WHEN {left} THEN '' ELSE {sibling} END}}"
        return f"SELECT tree, place, list({step} ORDER BY level) AS path FROM {rows} JOIN {name} USING (tree) WHERE len(nodes) > 1 GROUP BY tree, place"

    return f"""
    WITH RECURSIVE leaves AS MATERIALIZED (
        SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
            CASE WHEN {crc32} % 7 = 0 THEN {leaf("(n_chars::HUGEINT + 1)")} ELSE {leaf("n_chars")} END AS later
        FROM documents
    ),
    placed AS MATERIALIZED (
        SELECT *, dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS tree,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS place
        FROM leaves
    ),
    {levels("trees", "SELECT tree, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree")},
    subroots AS MATERIALIZED (SELECT tree AS place, 0 AS tree, nodes[1] AS subroot FROM trees WHERE len(nodes) = 1),
    {levels("crown", "SELECT 0 AS tree, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0")},
    low AS MATERIALIZED ({path("placed", "trees")}),
    high AS MATERIALIZED ({path("subroots", "crown")}),
    proofs AS MATERIALIZED (
        SELECT p.*, subroot, list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
        FROM placed p JOIN subroots s ON s.place = p.tree
        LEFT JOIN low ON low.tree = p.tree AND low.place = p.place LEFT JOIN high ON high.place = p.tree
    ),
    folds AS (
        SELECT tree, place, 1 AS level, path, later AS digest FROM proofs
        UNION ALL SELECT tree, place, level + 1, path, sha256(path[level]['left'] || digest || path[level]['right'])
        FROM folds WHERE level <= len(path)
    ),
    ends AS (SELECT tree, place, digest FROM folds WHERE level = len(path) + 1),
    root AS (SELECT nodes[1] AS root FROM crown WHERE len(nodes) = 1)
    SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(path, lambda s: s['left'] || s['right']), '')) AS proof_sha256,
        digest AS folded_root, digest = root AS verified
    FROM proofs JOIN ends USING (tree, place), root"""


def oracle() -> dict[str, str]:
    return {
        "op2_warc": _warc(),
        "op3_url_filter": _url_filter(),
        "op9_decontaminate": _decontaminate(),
        "op10_sentences": _sentences(),
        "op11_vector_codes": _vector_codes(),
        "op12_neighbours": _neighbours(),
        "op13_manifest": _manifest(),
    }
