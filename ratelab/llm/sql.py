"""DuckDB SQL with the results of the registered queries, where SQL can state them."""

from ratelab.llm.chat import AND, END, LEARNED_ROLE, TURN
from ratelab.llm.hash_tree import DIGITS, Topology

CRC_CODES = """
    codes AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS code)"""

EXACT_COPIES = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY text)"""

EMBEDDING_LINKS = """
    WITH RECURSIVE
    v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    usable AS (SELECT * FROM v
               WHERE label IS NOT NULL AND len(e) > 0
                 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b
              FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT a, b FROM links
              UNION
              SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.low, vec_id)) AS component_id,
           least(vec_id, coalesce(low.low, vec_id)) = vec_id AS kept
    FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id"""

SOURCE_MIX = r"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    ranked AS (SELECT source, source_size, 3 * source_size AS cap,
                      1000 * (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS unit
               FROM sources),
    filled AS (SELECT *, coalesce(sum(cap) OVER upto, 0) AS caps, coalesce(sum(unit) OVER upto, 0) AS units,
                      sum(source_size) OVER () AS total, sum(unit) OVER () AS all_units
               FROM ranked
               WINDOW upto AS (ORDER BY cap::DOUBLE / unit, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT (max(total) - coalesce(sum(cap) FILTER (WHERE full_up), 0))::DOUBLE
                     / nullif(max(all_units) - coalesce(sum(unit) FILTER (WHERE full_up), 0), 0)::DOUBLE AS level
              FROM (SELECT *, (total - caps) * unit > cap * (all_units - units) AS full_up FROM filled)),
    targets AS (SELECT source, source_size, least(cap::DOUBLE, unit::DOUBLE * coalesce(level, 0.0)) AS target,
                       least(round(least(cap::DOUBLE, unit::DOUBLE * coalesce(level, 0.0))), cap)::BIGINT AS words
                FROM filled, level),
    laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source
                                ORDER BY md5(concat_ws('|', doc_id::VARCHAR, '1')), doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
             FROM sized)
    SELECT doc_id, size, source_size, target,
           (CASE WHEN size = 0 THEN 0
                 ELSE words // source_size * size + greatest(0, least(size, words % source_size - place)) END)::BIGINT
               AS taken
    FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source"""

WARC_RECORDS = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    s AS (SELECT page_id, html, strlen(html) AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits,
                 min(page_id) OVER (PARTITION BY html) AS first
          FROM p)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
                  + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
                  + substr(bits, 5 * i + 5, 1)::INT), 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM s"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def chat_format(planted: str) -> str:
    said = _text(planted)

    def escaped(c):
        return rf"replace(replace({c}, '\', '\b'), '<|', '\l')"

    return rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}),
    marked AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
                         IS DISTINCT FROM role AS opens
               FROM rows)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
               AS turns_sha256,
           sum(CASE WHEN role = '{LEARNED_ROLE}' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
           sha256(string_agg(CASE WHEN role = '{LEARNED_ROLE}' THEN text ELSE '' END, ''
                             ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
           sum(length({escaped("text")}) + CASE WHEN opens
                   THEN {len(TURN) + 1 + len(END)} + length(replace({escaped("role")}, chr(10), '\n'))
                   ELSE {len(AND)} END)::BIGINT AS formatted_chars
    FROM marked GROUP BY conv_id"""


def hash_tree(topology: Topology) -> str:
    """Rows of the hash tree for a topology and the same one grown by a shard."""

    def draw(level, node, weight):
        label = f"md5(concat(coalesce(doc_id::VARCHAR, ''), '|{level}{node}'))"
        number = f"('0x' || substr({label}, 1, {DIGITS}))::BIGINT"
        return f"-ln(({number} + 0.5) / {float(16**DIGITS)!r}::DOUBLE) / {float(weight)!r}::DOUBLE"

    def winner(level, nodes):
        draws = ", ".join(f"{{'d': {draw(level, n, w)}, 'n': {n}}}" for n, w in nodes.items())
        return f"list_min([{draws}]).n"

    def branch(of, choices):
        return f"CASE {of} " + " ".join(f"WHEN {k} THEN {v}" for k, v in choices.items()) + " END"

    def steps(tree, name):
        regions = tree.regions()
        racks = {r: tree.racks(r) for r in regions}
        leaves = {k: tree.members(k) for r in regions for k in racks[r]}
        return (
            f"{name}_region AS (SELECT doc_id, {winner('region', regions)} AS region FROM ids), "
            f"{name}_rack AS (SELECT doc_id, "
            f"{branch('region', {r: winner('rack', racks[r]) for r in regions})} AS rack FROM {name}_region), "
            f"{name} AS (SELECT doc_id, "
            f"{branch('rack', {k: winner('shard', leaves[k]) for k in leaves})}::INT AS shard FROM {name}_rack)"
        )

    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    ids AS (SELECT DISTINCT doc_id FROM d), {steps(topology, "now")}, {steps(topology.grown(), "grown")},
    {CRC_CODES},
    hexed AS (SELECT doc_id, strlen(text) AS n, hex(encode(text)) AS h FROM d),
    bytes AS (SELECT doc_id, n, list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b
              FROM hexed),
    checksums AS (SELECT doc_id, n + 8 AS size,
                         xor(4294967295, list_reduce([4294967295] || b,
                             lambda c, x: xor(code[(xor(c, x) & 255) + 1], c >> 8))) AS text_crc32
                  FROM bytes, codes)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
    FROM (SELECT c.doc_id, c.size, c.text_crc32, now.shard, grown.shard AS grown_shard
          FROM checksums c JOIN now ON now.doc_id IS NOT DISTINCT FROM c.doc_id
          JOIN grown ON grown.doc_id IS NOT DISTINCT FROM c.doc_id)"""


INTERVAL_SEARCH = r"""
    WITH words AS (
        SELECT i, doc_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS i, doc_id, text FROM documents)),
    postings AS (SELECT i, doc_id, term, count(*) AS tf FROM words GROUP BY i, doc_id, term),
    lengths AS (SELECT i, sum(tf)::BIGINT AS n FROM postings GROUP BY i),
    whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
    weights AS (SELECT term, floor(1000 * ln((2 * max(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                FROM postings, whole GROUP BY term),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM benchmark),
    scored AS (SELECT item_id, i, doc_id,
                      sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT
                          AS score
               FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (i), whole
               GROUP BY item_id, i, doc_id)
    SELECT item_id, row_number() OVER best::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
    QUALIFY row_number() OVER best <= 10"""


def _tree_steps(name: str, start: str, levels: int) -> str:
    """CTEs ``<name>1`` and so on: runs of 8 children; a tree with one node left stays as it is."""
    steps, below = [], start
    for k in range(1, levels + 1):
        above = f"{name}{k}"
        steps.append(f"""
    {above}_runs AS (SELECT tree, place // 8 AS place, max(size) AS size, list(digest ORDER BY place) AS kids
                     FROM {below} GROUP BY tree, place // 8),
    {above} AS (SELECT tree, place, size > 1 AS grown, kids, (size + 7) // 8 AS size,
                       CASE WHEN size > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS digest
                FROM {above}_runs)""")
        below = above
    return ", ".join(steps)


def slot_pivot(levels: int = 8, group_levels: int = 4) -> str:
    """Trees of up to 8 to the ``levels`` rows, and a tree over their roots."""

    def written(c):
        text = f"{c}::VARCHAR"
        return f"coalesce(strlen({text})::VARCHAR || ':' || {text}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(written(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def before(k):
        return f"array_to_string({k}.kids[1:slot], '')"

    def after(k):
        return f"array_to_string({k}.kids[slot + 2:], '')"

    climbs, joined = [], "leaves"
    rounds = [(f"up{k}", "tree", "place") for k in range(1, levels + 1)]
    rounds += [(f"top{k}", "0", "tree") for k in range(1, group_levels + 1)]
    power = {"place": 1, "tree": 1}
    for n, (k, tree, place) in enumerate(rounds):
        # The node's place at this level, its slot in the run, and the run's place above.
        at = f"(l.{place} // {power[place]})"
        power[place] *= 8
        on = f"{k}.place = l.{place} // {power[place]} AND {k}.tree = " + ("l.tree" if tree == "tree" else "0")
        climbs.append(f"""
    climb{n} AS (SELECT l.* REPLACE (
                     CASE WHEN grown THEN l.proof || {before(k)} || {after(k)} ELSE l.proof END AS proof,
                     CASE WHEN grown THEN sha256({before(k)} || l.folded || {after(k)}) ELSE l.folded END AS folded)
                 FROM (SELECT l.*, {at} % 8 AS slot FROM {joined} l) l JOIN {k} ON {on})""".replace(
            "l.* REPLACE", "l.* EXCLUDE (slot) REPLACE"))
        joined = f"climb{n}"
    return f"""
    WITH {CRC_CODES},
    d AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
                 xor(4294967295, list_reduce([4294967295] || list_transform(range(strlen(doc_id::VARCHAR)),
                         lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
                     lambda c, x: xor(code[(xor(c, x) & 255) + 1], c >> 8))) % 3 = 0 AS tampered
          FROM documents, codes),
    hashed AS (SELECT doc_id, tree, {leaf("text")} AS leaf,
                      CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                           ELSE text END AS claimed_text, source, lang, n_chars
               FROM d),
    claims AS (SELECT doc_id, tree, leaf, {leaf("claimed_text")} AS claimed FROM hashed),
    leaves AS (SELECT doc_id, tree, leaf, claimed AS folded, '' AS proof,
                      row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                      count(*) OVER (PARTITION BY tree) AS size
               FROM claims),
    up0 AS (SELECT tree, place, size, leaf AS digest FROM leaves),
    {_tree_steps("up", "up0", levels)},
    subroots AS (SELECT tree, digest FROM up{levels}),
    top0 AS (SELECT 0 AS tree, tree AS place, count(*) OVER () AS size, digest FROM subroots),
    {_tree_steps("top", "top0", group_levels)},
    {", ".join(climbs)}
    SELECT doc_id, leaf, subroots.digest AS subroot, top{group_levels}.digest AS root, sha256(proof) AS proof_sha256,
           folded AS folded_root, folded = top{group_levels}.digest AS verified
    FROM {joined} c JOIN subroots USING (tree), top{group_levels}"""


SLOT_PIVOT = slot_pivot()
