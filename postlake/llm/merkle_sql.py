"""SQL for the Merkle manifest: every level of every tree spelled out, for trees of up to 8 ** LEVELS leaves and groups."""

FAN = 8
LEVELS = 8


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v})::VARCHAR || ':' || {v} END" for v in values]
    return f"sha256({' || '.join(parts)})"


def _levels(name: str, tree: str) -> list[str]:
    """CTEs `{name}_run{k}`: the runs of each level, and `{name}_node{k}`: its nodes."""
    made = []
    for k in range(LEVELS):
        made.append(f"""{name}_run{k} AS (
            SELECT {tree}, i // {FAN} AS j, list(h ORDER BY i) AS hs, any_value(n) AS n
            FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS n FROM {name}_node{k}) GROUP BY {tree}, j)""")
        made.append(f"""{name}_node{k + 1} AS (
            SELECT {tree}, j AS i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_run{k})""")
    return made


def _walk(rows: str, name: str, tree: str, at: str) -> list[str]:
    """CTEs `{rows}{k}`: the rows with the siblings up to level k, joined, and the hash folded so far."""
    made = []
    for k in range(LEVELS):
        place = f"(r.{at} // {FAN**k}) % {FAN} + 1"
        left, right = f"array_to_string(s.hs[1:{place} - 1], '')", f"array_to_string(s.hs[{place} + 1:], '')"
        made.append(f"""{rows}{k + 1} AS (
            SELECT r.* EXCLUDE (proof, f), CASE WHEN s.n = 1 THEN r.proof ELSE r.proof || {left} || {right} END AS proof,
                   CASE WHEN s.n = 1 THEN r.f ELSE sha256({left} || r.f || {right}) END AS f
            FROM {rows}{k} r JOIN {name}_run{k} s ON r.{tree} = s.{tree} AND r.{at} // {FAN ** (k + 1)} = s.j)""")
    return made


# crc32 of the decimal id, bit by bit.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))))"""

MANIFEST = ", ".join([
    f"""WITH leaf AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("text")} AS h,
                   CASE WHEN coalesce({CRC32}, 0) % 3 = 0
                        THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS shown
            FROM documents
        )""",
    """a0 AS (
            SELECT doc_id, tree, h, coalesce(shown, h) AS f, '' AS proof,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i
            FROM leaf
        )""",
    "leaf_node0 AS (SELECT tree, i, h FROM a0)",
    *_levels("leaf", "tree"),
    *_walk("a", "leaf", "tree", "i"),
    f"top_node0 AS (SELECT 0 AS t, row_number() OVER (ORDER BY tree) - 1 AS i, h, tree FROM leaf_node{LEVELS})",
    *_levels("top", "t"),
    f"b0 AS (SELECT a.* EXCLUDE (i), g.t, g.i AS i, g.h AS subroot FROM a{LEVELS} a JOIN top_node0 g ON a.tree = g.tree)",
    *_walk("b", "top", "t", "i"),
]) + f"""
        SELECT doc_id, b.h AS leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified
        FROM b{LEVELS} b, top_node{LEVELS} r
    """
