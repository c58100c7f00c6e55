"""SQL twins of the registered queries, on the same tables, for an independent engine."""

from __future__ import annotations

from wordloom.plans.queries import (
    CUT_LENGTH,
    CUT_START,
    DIVISOR,
    FOLD_CHUNK,
    MIN_COUNT,
    MODEL,
    PAD,
    SHARDS,
    SIZE,
    STRIDE,
)

LINES = r"""
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|[\r\n]') AS parts
        FROM documents WHERE text <> ''))"""

LINES_ALL = LINES.replace("FROM documents", """FROM (
          SELECT doc_id, text FROM documents UNION ALL SELECT conv_id, text FROM conversations
          UNION ALL SELECT item_id, text FROM benchmark UNION ALL SELECT page_id, html FROM pages)""")


def _word_list(text: str) -> str:
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN rtrim({text}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({text}, ' '), ' ') END"
    )


MODEL_WORDS = f"""
used AS (
  SELECT doc_id % 2 AS shard, CAST(unnest(vec[1:{SIZE} - n_pads]) AS INTEGER) AS token_id FROM samples),
per_shard AS (
  SELECT shard, token_id FROM used GROUP BY ALL HAVING count(*) >= {MODEL.min_count}),
sizes AS (SELECT shard, count(*) AS size FROM per_shard GROUP BY ALL)"""

WORDS = f"""
words AS (
  SELECT doc_id, line_no, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS word_idx, unnest(ws) AS word
  FROM (SELECT doc_id, line_no, {_word_list('line')} AS ws FROM lines))"""


def _sentences(pattern: str) -> str:
    return rf"""
sentences AS (
  SELECT doc_id, line_no, sentence_idx, sentence
  FROM (SELECT doc_id, line_no, len(parts) AS n, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sentence_idx,
               unnest(parts) AS sentence,
               coalesce(list_max(list_transform(parts, lambda p, i: CASE WHEN p <> '' THEN i END)), 0) AS filled
        FROM (SELECT doc_id, line_no, string_split_regex(line, '{pattern}') AS parts FROM lines))
  WHERE n = 1 OR sentence_idx < filled)"""


SENTENCES = _sentences(".?!")
SENTENCES_PUNCT = _sentences("[.?!]")

TOKENS = f"""
tokens AS (
  SELECT * FROM (
    SELECT doc_id, line_no, sentence_idx, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS tok_idx, unnest(ws) AS word
    FROM (SELECT doc_id, line_no, sentence_idx, {_word_list('sentence')} AS ws FROM sentences))
  WHERE word <> '')"""


def _dictionary(source: str) -> str:
    return f"""
dictionary AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS token_id
  FROM (SELECT word, count(*) AS n FROM {source} WHERE word <> '' GROUP BY word))"""


IDS = """
ids AS (
  SELECT doc_id, line_no, sentence_idx, list(token_id ORDER BY tok_idx) AS token_ids
  FROM tokens JOIN dictionary USING (word) GROUP BY ALL)"""

BYTE_IDS = """
ids AS (
  SELECT doc_id, line_no, sentence_idx,
         list_transform(regexp_extract_all(hex(encode(replace(sentence, ' ', ''))), '..'),
                        lambda h: CAST('0x' || h AS INTEGER)) AS token_ids
  FROM sentences WHERE rtrim(sentence, ' ') <> '')"""

WINDOWS = f"""
counted AS (
  SELECT *, len(token_ids) AS n,
         least(CAST(ceil(greatest(len(token_ids) - {SIZE}, 0) / {STRIDE}::DOUBLE) AS BIGINT) + 1,
               CAST(ceil(len(token_ids) / {STRIDE}::DOUBLE) AS BIGINT)) AS k
  FROM ids),
placed AS (
  SELECT doc_id, line_no, sentence_idx, CAST(unnest(range(k)) AS INTEGER) AS sample_idx, token_ids, n FROM counted),
samples AS (
  SELECT doc_id, line_no, sentence_idx, sample_idx,
         CAST(greatest(sample_idx * {STRIDE} + {SIZE} - n, 0) AS INTEGER) AS n_pads,
         list_transform(range({SIZE}), lambda j:
           CAST(coalesce(token_ids[sample_idx * {STRIDE} + j + 1], {PAD}) AS FLOAT)) AS vec,
         concat_ws('-', doc_id, line_no, sentence_idx, sample_idx) AS sample_key
  FROM placed)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


TO_SENTENCES = _with(LINES, SENTENCES)
TO_IDS = _with(LINES, SENTENCES, TOKENS, _dictionary("tokens"), IDS)
TO_SAMPLES = _with(LINES, SENTENCES, TOKENS, _dictionary("tokens"), IDS, WINDOWS)
TO_COUNTS = _with(LINES, WORDS, _dictionary("words"), """
counted_ids AS (
  SELECT word, n, CAST(token_id AS VARCHAR) AS ids_str FROM dictionary
  UNION ALL SELECT word, count(*) AS n, '' AS ids_str FROM words WHERE word = '' GROUP BY word)""")

VEC_STR = "array_to_string(list_transform(vec, lambda x: CAST(x AS VARCHAR)), ';') AS vec_str"

ORDER_NO = "doc_id, line_no, sentence_idx, sample_idx"

POSITIONS = "CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, unnest(v) AS value"

SCALED = "list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS FLOAT))"

PAIRS = """
pairs AS (
  SELECT a.vec_id AS a_id, b.vec_id AS b_id, a.embedding AS a, b.embedding AS b
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def _square(x: str) -> str:
    return f"CAST(pow(CAST({x} AS DOUBLE), 2) AS FLOAT)"


def _fold(v: str) -> str:
    return f"list_reduce({v}, lambda acc, x: {_square('acc')} * {_square('x')})"


NEAREST = """
unit AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sims AS (
  SELECT a.vec_id, b.vec_id AS near_id, round(list_cosine_similarity(a.v, b.v), 9) AS sim
  FROM unit a JOIN unit b ON a.vec_id <> b.vec_id),
nearest AS (
  SELECT vec_id, near_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, near_id) AS INTEGER) AS rank
  FROM sims QUALIFY rank <= 5),
freq AS (
  SELECT label, near_id, count(*) AS n FROM nearest JOIN embeddings USING (vec_id) GROUP BY ALL)"""

MERGED = """
named AS (
  SELECT a.label AS token_id, b.label AS near_id, count(*) AS n
  FROM nearest JOIN embeddings a USING (vec_id) JOIN embeddings b ON b.vec_id = near_id GROUP BY ALL),
top AS (
  SELECT token_id, string_agg('label ' || near_id, ', ' ORDER BY rank) AS near_str
  FROM (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY n DESC, near_id) AS rank FROM named QUALIFY rank <= 3)
  GROUP BY token_id),
means AS (
  SELECT label AS token_id, pos, CAST(avg(CAST(x AS DOUBLE)) AS FLOAT) AS mean
  FROM (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS x FROM embeddings)
  GROUP BY ALL)"""

# Written apart from the operator's pattern: the engine's own reading of numbers, less what only it reads.
IS_NUMBER = "(TRY_CAST(raw AS DOUBLE) IS NOT NULL AND translate(raw, '0123456789+-.eE', '') = '')"
TEXT_TO_ID = f"CASE WHEN {IS_NUMBER} THEN TRY_CAST(floor(TRY_CAST(raw AS FLOAT)) AS INTEGER) END"


def _csv(column: str) -> str:
    quoted = f"""'"' || replace({column}, '"', '""') || '"'"""
    return rf"""CASE WHEN regexp_matches({column}, '[,"\r\n]') THEN {quoted} ELSE {column} END"""


ORACLES: dict[str, str] = {
    "text_lines": f"{_with(LINES)} SELECT * FROM lines",
    "word_explode": f"{_with(LINES, WORDS)} SELECT * FROM words",
    "sentence_split": f"{TO_SENTENCES} SELECT * FROM sentences",
    "sentence_split_punct": f"{_with(LINES, SENTENCES_PUNCT)} SELECT * FROM sentences",
    "sentence_index": f"""{TO_SENTENCES}
        SELECT doc_id, line_no, CAST(n AS INTEGER) AS n_sentences, CAST(n - 1 AS INTEGER) AS max_idx
        FROM (SELECT l.doc_id, l.line_no, count(s.sentence_idx) AS n
              FROM lines l LEFT JOIN sentences s ON l.doc_id = s.doc_id AND l.line_no = s.line_no GROUP BY ALL)""",
    "empty_sentences": f"""{_with(LINES, SENTENCES_PUNCT)}
        SELECT doc_id, line_no, sentence_idx FROM sentences WHERE rtrim(sentence, ' ') = ''""",
    "shard_assign": f"""SELECT CAST(doc_id % {SHARDS} AS INTEGER) AS shard_id, count(*) AS n_rows,
        CAST(sum(octet_length(encode(text))) AS BIGINT) AS n_bytes FROM documents GROUP BY ALL""",
    "shard_by_bytes": f"""WITH b AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n FROM documents),
        s AS (SELECT doc_id, CAST(sum(n) OVER (ORDER BY doc_id) - n AS BIGINT) AS before, CAST(sum(n) OVER () AS BIGINT) AS total FROM b)
        SELECT doc_id, CAST(before * {SHARDS} // total AS INTEGER) AS shard_id FROM s""",
    "word_count": f"{_with(LINES, WORDS)} SELECT word, count(*) AS n FROM words GROUP BY word",
    "word_count_all": f"""{_with(LINES_ALL, WORDS)} SELECT word, count(*) AS n FROM words GROUP BY word""",
    "vocab_min_count": f"""{_with(LINES, WORDS)}
        SELECT word, count(*) AS n FROM words GROUP BY word HAVING count(*) >= {MIN_COUNT}""",
    "vocab_size": f"{_with(LINES, WORDS)} SELECT count(DISTINCT word) AS vocab_size FROM words",
    "word_count_with_ids": f"{TO_COUNTS} SELECT * FROM counted_ids",
    "word_count_csv": f"""{TO_COUNTS}
        SELECT {_csv('word')} || ',' || n || ',' || ids_str AS line FROM counted_ids""",
    "vocab_size_legacy": f"""{TO_COUNTS}
        SELECT CAST(coalesce(sum(CASE WHEN ids_str = '' THEN 1 ELSE length(ids_str) END), 0) AS BIGINT) AS vocab_size
        FROM counted_ids""",
    "encode_dictionary": f"{_with(LINES, SENTENCES, TOKENS, _dictionary('tokens'))} SELECT word, token_id FROM dictionary",
    "decode_tokens": f"""{_with(LINES, SENTENCES, TOKENS, _dictionary('tokens'))}
        SELECT DISTINCT token_id, word AS token FROM tokens JOIN dictionary USING (word)""",
    "encode_bytes": f"""{_with(LINES, WORDS)}
        SELECT word, coalesce(array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
          lambda h: CAST('0x' || h AS INTEGER)), ';'), '') AS ids_str
        FROM (SELECT DISTINCT word FROM words)""",
    "decode_bytes": f"""{_with(LINES, SENTENCES, BYTE_IDS)}
        SELECT token_id, CASE WHEN token_id < 128 THEN chr(token_id) ELSE chr(65533) END AS token
        FROM (SELECT DISTINCT unnest(token_ids) AS token_id FROM ids)""",
    "sliding_windows_bytes": f"{_with(LINES, SENTENCES, BYTE_IDS, WINDOWS)} SELECT {ORDER_NO}, {VEC_STR} FROM samples",
    "sentence_token_ids": f"""{TO_IDS}
        SELECT doc_id, line_no, sentence_idx, array_to_string(token_ids, ';') AS ids_str FROM ids""",
    "sliding_windows": f"{TO_SAMPLES} SELECT {ORDER_NO}, {VEC_STR} FROM samples",
    "pad_windows": f"{TO_SAMPLES} SELECT {ORDER_NO}, {VEC_STR}, n_pads FROM samples WHERE n_pads > 0",
    "sample_keys": f"{TO_SAMPLES} SELECT sample_key FROM samples",
    "samples_dedup": f"""{TO_SAMPLES}, twice AS (SELECT * FROM samples UNION ALL SELECT * FROM samples)
        SELECT sample_key, min(vec_str) AS vec_str FROM (SELECT sample_key, {VEC_STR} FROM twice) GROUP BY sample_key""",
    "samples_ordered": f"""{TO_SAMPLES}
        SELECT {ORDER_NO}, row_number() OVER (ORDER BY {ORDER_NO}) AS position FROM samples""",
    "sample_weight_legacy": f"""{TO_SAMPLES}
        SELECT sample_key, CAST(length(array_to_string(list_transform(vec, lambda x: CAST(x AS VARCHAR)), ' ')) AS INTEGER)
          AS weight FROM samples""",
    "samples_parse": f"""{TO_SAMPLES}
        SELECT sample_key, CAST(len(vec) AS INTEGER) AS n_tokens, CAST(vec[1] AS INTEGER) AS first_id,
          CAST(vec[-1] AS INTEGER) AS last_id FROM samples""",
    "samples_rescan": f"""{TO_SAMPLES},
        texts AS (SELECT sample_key || chr(9) || vec_str AS line FROM (SELECT sample_key, {VEC_STR} FROM samples)
          UNION ALL SELECT line FROM lines UNION ALL SELECT doc_id || chr(9) || line FROM lines),
        cut AS (SELECT string_split(line, chr(9)) AS f FROM texts),
        judged AS (SELECT CASE WHEN len(f) <> 2 THEN 'not a key and a vector' WHEN f[1] = '' THEN 'no key' WHEN f[2] = '' THEN 'no vector'
            WHEN len(list_filter(string_split_regex(f[2], '[; ]'), lambda x: NOT regexp_matches(x, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'))) > 0 THEN 'not a number'
            WHEN len(string_split_regex(f[2], '[; ]')) <> {SIZE} THEN 'wrong length' ELSE 'good' END AS reason FROM cut)
        SELECT reason, count(*) AS n FROM judged GROUP BY reason""",
    "token_id_from_text": f"""{TO_SAMPLES}, texts AS (
        SELECT DISTINCT unnest(list_transform(vec, lambda x: CAST(x AS VARCHAR))) AS raw FROM samples)
        SELECT raw, {TEXT_TO_ID} AS token_id FROM texts""",
    "reject_bad_tokens": f"""{_with(LINES, WORDS, SENTENCES, TOKENS, _dictionary('tokens'))},
        read AS (SELECT raw, n, {TEXT_TO_ID} AS token_id FROM (SELECT word AS raw, count(*) AS n FROM words GROUP BY word))
        SELECT raw, n, CASE WHEN {IS_NUMBER} THEN 'unknown id' ELSE 'not a number' END AS reason
        FROM read WHERE token_id IS NULL OR token_id NOT IN (SELECT token_id FROM dictionary)""",
    "accept_good_tokens": f"""{_with(LINES, WORDS, SENTENCES, TOKENS, _dictionary('tokens'))},
        read AS (SELECT raw, n, {TEXT_TO_ID} AS token_id FROM (SELECT word AS raw, count(*) AS n FROM words GROUP BY word))
        SELECT raw, n, token_id FROM read WHERE token_id IN (SELECT token_id FROM dictionary)""",
    "samples_tsv": f"""{TO_SAMPLES}, texts AS (SELECT sample_key, {VEC_STR} FROM samples)
        SELECT sample_key || chr(9) || vec_str AS line FROM texts""",
    "word2vec_coverage": f"""{TO_SAMPLES}
        SELECT token_id, CAST({MODEL.dim} AS INTEGER) AS dim, true AS finite
        FROM (SELECT CAST(unnest(vec[1:{SIZE} - n_pads]) AS INTEGER) AS token_id FROM samples)
        GROUP BY token_id HAVING count(*) >= {MODEL.min_count}""",
    "cooccurrence_totals": f"""{TO_SAMPLES},
        w AS (SELECT row_number() OVER () AS id, vec[1:{SIZE} - n_pads] AS ids FROM samples),
        p AS (SELECT id, CAST(unnest(ids) AS INTEGER) AS t, generate_subscripts(ids, 1) AS i FROM w),
        n AS (SELECT x.t AS a, y.t AS b, count(*) AS n FROM p x JOIN p y ON x.id = y.id AND x.i <> y.i AND abs(x.i - y.i) <= {MODEL.window} GROUP BY ALL),
        m AS (SELECT a, sum(n) AS m FROM n GROUP BY a),
        s AS (SELECT sum(m) AS s FROM m)
        SELECT n.a AS token_id, count(*) AS n_near, CAST(sum(n) AS BIGINT) AS n_places, count(*) FILTER (n * s > u.m * v.m) AS n_positive
        FROM n JOIN m u ON u.a = n.a JOIN m v ON v.a = n.b, s GROUP BY n.a""",
    "counts_coverage": f"""{TO_SAMPLES}
        SELECT token_id, CAST({MODEL.dim} AS INTEGER) AS dim, true AS finite
        FROM (SELECT CAST(unnest(vec[1:{SIZE} - n_pads]) AS INTEGER) AS token_id FROM samples)
        GROUP BY token_id HAVING count(*) >= {MODEL.min_count}""",
    "embedding_aligned": "SELECT vec_id, CAST(2 AS INTEGER) AS n_models, true AS same FROM embeddings",
    "ensemble_coverage": f"""{_with(LINES, SENTENCES, TOKENS, _dictionary('tokens'), IDS, WINDOWS, MODEL_WORDS)}
        SELECT token_id, CAST(count(*) AS INTEGER) AS n_models, CAST({MODEL.dim} AS INTEGER) AS dim, true AS finite
        FROM per_shard GROUP BY token_id""",
    "embedding_coverage": f"""{_with(LINES, SENTENCES, TOKENS, _dictionary('tokens'), IDS, WINDOWS, MODEL_WORDS)}
        SELECT token_id, word AS token, CAST(least(max(size) - 1, {MODEL.kept}) AS INTEGER) AS n_near
        FROM per_shard JOIN sizes USING (shard) JOIN dictionary USING (token_id) GROUP BY token_id, word""",
    "vector_to_string": f"""SELECT vec_id, array_to_string(list_transform({SCALED}, lambda x: CAST(x AS VARCHAR)), ';') AS text
        FROM embeddings""",
    "vector_parse": f"""SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
        CAST(list_sum({SCALED}) AS BIGINT) AS total FROM embeddings""",
    "vector_add": f"""{_with(PAIRS)} SELECT vec_id, {POSITIONS} FROM (
        SELECT a_id AS vec_id, list_transform(list_zip(a, b), lambda p: CAST(p[1] + p[2] AS FLOAT)) AS v FROM pairs)""",
    "vector_divide": f"""SELECT vec_id, {POSITIONS} FROM (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) / {DIVISOR} AS FLOAT)) AS v FROM embeddings)""",
    "vector_slice": f"""SELECT vec_id, {POSITIONS} FROM (
        SELECT vec_id, embedding[{CUT_START + 1}:{CUT_START + CUT_LENGTH}] AS v FROM embeddings)""",
    "vector_copy_range": f"""SELECT vec_id, {POSITIONS} FROM (
        SELECT vec_id, list_transform(embedding, lambda x, i:
          CASE WHEN i > {CUT_START} AND i <= {CUT_START + CUT_LENGTH} THEN x ELSE CAST(0 AS FLOAT) END) AS v FROM embeddings)""",
    "vector_fold_compare": f"""{_with(PAIRS)},
        pieces AS (SELECT a_id, b_id, CAST(unnest(range(CAST(ceil(len(a) / {FOLD_CHUNK}::DOUBLE) AS BIGINT))) AS INTEGER) AS piece, a, b
                   FROM pairs),
        folds AS (SELECT a_id, b_id, piece,
                    {_fold(f'a[piece * {FOLD_CHUNK} + 1 : piece * {FOLD_CHUNK} + {FOLD_CHUNK}]')} AS fa,
                    {_fold(f'b[piece * {FOLD_CHUNK} + 1 : piece * {FOLD_CHUNK} + {FOLD_CHUNK}]')} AS fb
                  FROM pieces)
        SELECT a_id, b_id, piece, CAST(CASE WHEN fa = fb THEN 0 WHEN fa < fb THEN -1 ELSE 1 END AS INTEGER) AS cmp FROM folds""",
    "vector_mean": """SELECT label, pos, round(avg(CAST(value AS DOUBLE)), 6) AS mean FROM (
        SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS value FROM embeddings)
        GROUP BY label, pos""",
    "nearest_words": f"{_with(NEAREST)} SELECT * FROM nearest",
    "nearest_words_recall": f"""{_with(NEAREST)}
        SELECT count(DISTINCT vec_id) AS n_queries, count(*) AS n_exact, true AS reached FROM nearest WHERE vec_id % 50 = 0""",
    "neighbour_freq": f"{_with(NEAREST)} SELECT * FROM freq",
    "embedding_merge": f"""{_with(NEAREST, MERGED)}
        SELECT token_id, 'label ' || token_id AS token, pos, round(CAST(mean AS DOUBLE), 5) AS value, near_str
        FROM means JOIN top USING (token_id)""",
    "embeddings_csv": f"""{_with(NEAREST, MERGED)},
        rows AS (SELECT token_id, string_agg(CAST(floor(CAST(mean AS DOUBLE) * 100) AS INTEGER), ';' ORDER BY pos) AS vec FROM means GROUP BY ALL)
        SELECT 'label ' || token_id || ',' || vec || ',' || CASE WHEN contains(near_str, ',') THEN '"' || near_str || '"' ELSE near_str END AS line
        FROM rows JOIN top USING (token_id)""",
    "neighbour_top3": f"""{_with(NEAREST)}
        SELECT label, near_id, CAST(row_number() OVER (PARTITION BY label ORDER BY n DESC, near_id) AS INTEGER) AS rank
        FROM freq QUALIFY rank <= 3""",
}
