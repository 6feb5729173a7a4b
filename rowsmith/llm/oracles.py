"""SQL for the manifest, spelling and fingerprint queries."""

#: The table of the cyclic redundancy check of 32 bits, built from its polynomial.
CRC_TABLE = """
        crc_table AS (
          SELECT list(v ORDER BY n) AS t FROM (
            SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)),
              lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(n)))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, where crc_table is among the tables joined."""
    code = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code}), {step}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MANIFEST = f"""
        WITH RECURSIVE {CRC_TABLE},
        leaves AS (
          SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
            CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS changed
          FROM documents, crc_table),
        placed AS (
          SELECT *, row_number() OVER () AS uid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot
          FROM leaves),
        nodes(lang, level, pos, digest) AS (
          SELECT lang, 0::BIGINT, slot, leaf FROM placed
          UNION ALL
          SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
          FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes) WHERE n > 1 GROUP BY lang, level, pos // 2),
        heights AS (SELECT lang, max(level) AS height FROM nodes GROUP BY lang),
        subroots AS (
          SELECT n.lang, n.digest, row_number() OVER (ORDER BY n.lang NULLS FIRST) - 1 AS slot
          FROM nodes n JOIN heights h ON n.lang IS NOT DISTINCT FROM h.lang AND n.level = h.height),
        tops(level, pos, digest) AS (
          SELECT 0::BIGINT, slot, digest FROM subroots
          UNION ALL
          SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
          FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, pos // 2),
        top AS (SELECT level AS height, digest AS root FROM tops ORDER BY level DESC LIMIT 1),
        steps AS (
          SELECT p.uid, r.i AS step, (p.slot >> r.i) % 2 AS side, s.digest AS sibling
          FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang JOIN range(64) AS r(i) ON r.i < h.height
          LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = r.i AND s.pos = xor(p.slot >> r.i, 1)
          UNION ALL
          SELECT p.uid, h.height + r.i, (u.slot >> r.i) % 2, s.digest
          FROM placed p JOIN heights h ON p.lang IS NOT DISTINCT FROM h.lang JOIN subroots u ON u.lang IS NOT DISTINCT FROM p.lang
          JOIN top ON true JOIN range(64) AS r(i) ON r.i < top.height
          LEFT JOIN tops s ON s.level = r.i AND s.pos = xor(u.slot >> r.i, 1)),
        folds(uid, step, digest) AS (
          SELECT uid, 0::BIGINT, coalesce(changed, leaf) FROM placed
          UNION ALL
          SELECT f.uid, f.step + 1,
            sha256(CASE WHEN s.side = 1 THEN coalesce(s.sibling, '') || f.digest ELSE f.digest || coalesce(s.sibling, '') END)
          FROM folds f JOIN steps s ON s.uid = f.uid AND s.step = f.step),
        ends AS (SELECT uid, arg_max(digest, step) AS folded_root FROM folds GROUP BY uid),
        proofs AS (SELECT uid, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY uid)
        SELECT p.doc_id, p.lang, p.slot, p.leaf, u.digest AS subroot, top.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
          e.folded_root, e.folded_root = top.root AS verified
        FROM placed p JOIN subroots u ON u.lang IS NOT DISTINCT FROM p.lang JOIN ends e USING (uid) LEFT JOIN proofs q USING (uid), top"""

SPELLING = f"""
        WITH RECURSIVE {CRC_TABLE},
        runs AS (
          SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        counted AS (
          SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS spot, run, count(*) AS times
          FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
        marked AS (SELECT run, times, {crc32("spot")} AS h FROM counted, crc_table),
        typed AS (
          SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
            times FROM marked),
        words AS (SELECT word, sum(times)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
        spots AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
        pairs AS (
          SELECT a.word AS a, b.word AS b FROM spots a JOIN spots b
            ON a.i = b.i AND left(a.word, a.i) || '*' || substr(a.word, a.i + 2) = left(b.word, b.i) || '*' || substr(b.word, b.i + 2) AND a.word <> b.word
          UNION SELECT s.word, w.word FROM spots s JOIN words w ON w.word = left(s.word, s.i) || substr(s.word, s.i + 2)
          UNION SELECT w.word, s.word FROM spots s JOIN words w ON w.word = left(s.word, s.i) || substr(s.word, s.i + 2)),
        ordered AS (
          SELECT a AS word, b AS near, w.n AS near_n, count(*) OVER (PARTITION BY a) AS n_near,
            row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
          FROM pairs JOIN words w ON w.word = b),
        forms AS (
          SELECT w.word, w.n, coalesce(o.n_near, 0)::BIGINT AS n_near, CASE WHEN o.near_n >= 2 * w.n THEN o.near END AS form,
            CASE WHEN o.near_n >= 2 * w.n THEN o.near_n END AS form_n
          FROM words w LEFT JOIN ordered o ON o.word = w.word AND o.place = 1),
        ways(word, here, form) AS (
          SELECT word, word, form FROM forms
          UNION ALL SELECT w.word, f.word, f.form FROM ways w JOIN forms f ON f.word = w.form)
        SELECT f.word, f.form, w.here AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
        FROM forms f JOIN ways w ON w.word = f.word AND w.form IS NULL"""


def fingerprints(k: int, window: int) -> str:
    """CRC-32 is linear: that of a run is the exclusive or of what each character gives at its distance from the
    end (lin) and of the CRC-32 of as many zeros (nil)."""
    rolled = ", ".join(f"lead(lin[{k - j}], {j}) OVER spot" for j in range(k))
    rolled = f"list_reduce([{rolled}], lambda x, y: xor(x, y))"
    bytes_of = "[c >> 24, (c >> 16) & 255, (c >> 8) & 255, c & 255]"
    step = "lambda x, y: xor(x >> 8, t[xor(x, y) % 256 + 1])"
    return f"""
        WITH {CRC_TABLE},
        ordered AS (
          SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC) AS r, count(*) OVER () AS m FROM documents),
        pairs AS (
          SELECT a.doc_id, b.doc_id AS next_id, length(a.text) AS n_chars, a.text,
            left(a.text, length(a.text) - length(a.text) // 3) || left(b.text, length(a.text) // 3) AS edited
          FROM ordered a JOIN ordered b ON b.r = a.r % a.m + 1),
        texts AS (SELECT doc_id, 0 AS kind, text FROM pairs UNION ALL SELECT doc_id, 1, edited FROM pairs),
        letters AS (SELECT doc_id, kind, length(text) AS n, regexp_extract_all(text, '(?s).') AS c FROM texts),
        codes AS (SELECT doc_id, kind, n, i, unicode(c[i + 1])::BIGINT AS c FROM letters, unnest(range(n)) AS u(i)),
        tables AS (
          SELECT c, list_transform(range({k}), lambda d: list_reduce(
            list_prepend(0::BIGINT, list_concat({bytes_of}, list_transform(range(4 * d), lambda z: 0::BIGINT))), {step})) AS lin
          FROM (SELECT DISTINCT c FROM codes), crc_table),
        zeros AS (
          SELECT list_transform(range(1, {k + 1}), lambda d: xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(4 * d), lambda z: 0::BIGINT)), {step}), 4294967295)) AS nil FROM crc_table),
        grams AS (
          SELECT doc_id, kind, n, i, xor(nil[least(n, {k})], CASE WHEN n >= {k} THEN {rolled}
            ELSE bit_xor(lin[least(n, {k}) - i]) OVER (PARTITION BY doc_id, kind) END) AS hash
          FROM codes JOIN tables USING (c), zeros WINDOW spot AS (PARTITION BY doc_id, kind ORDER BY i)),
        spots AS (
          SELECT doc_id, kind, n, i, min(hash * 2147483648 + 2147483647 - i) OVER (
            PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS run
          FROM grams WHERE i <= greatest(n - {k}, 0)),
        runs AS (
          SELECT DISTINCT doc_id, kind, run >> 31 AS hash, 2147483647 - (run & 2147483647) AS place
          FROM spots WHERE i <= greatest(n - {k + window - 1}, 0)),
        found AS (
          SELECT doc_id, kind, string_agg(hash || '@' || place, ' ' ORDER BY place) AS fingerprint, list(DISTINCT hash) AS hashes
          FROM runs GROUP BY doc_id, kind),
        known AS (
          SELECT t.doc_id, t.kind, coalesce(fingerprint, '') AS fingerprint, coalesce(hashes, []) AS hashes
          FROM texts t LEFT JOIN found f ON f.doc_id = t.doc_id AND f.kind = t.kind),
        near AS (
          SELECT p.doc_id, p.n_chars, p.edited, a.fingerprint, b.fingerprint AS edited_fingerprint,
            len(list_intersect(a.hashes, b.hashes)) AS x, len(a.hashes) + len(b.hashes) AS y,
            len(list_intersect(a.hashes, c.hashes)) AS u, len(a.hashes) + len(c.hashes) AS v
          FROM pairs p JOIN known a ON a.doc_id = p.doc_id AND a.kind = 0 JOIN known b ON b.doc_id = p.doc_id AND b.kind = 1
          JOIN known c ON c.doc_id = p.next_id AND c.kind = 0)
        SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
          CASE WHEN y = 0 THEN 1.0::DOUBLE ELSE x / (y - x) END AS near_edited,
          CASE WHEN v = 0 THEN 1.0::DOUBLE ELSE u / (v - u) END AS near_next
        FROM near"""
