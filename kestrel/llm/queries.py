"""The registered query of every operator: thin digests of the real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load
from . import (collocations, importance, jaccard, line_align, line_quality, nbsvm, packing, pieces, pii, substring,
               tiling, warc, wordpiece)


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_patience_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_align.without_repeated_lines(load(spark, sf_dir, "documents").select("doc_id", "text"),
                                            removed_col="n_removed", every_copy=True)
    return out.select("doc_id", "n_removed", F.sha2("text", 256).alias("kept_sha256"), F.length("text").alias("kept_chars"))


def op2_shape_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.found(load(spark, sf_dir, "documents")))


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(load(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(load(spark, sf_dir, "documents"))


def op5_warc_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(load(spark, sf_dir, "pages"))


def op6_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(load(spark, sf_dir, "documents"))


def op7_line_labelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judged(load(spark, sf_dir, "documents"))


def op8_longest_match_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(load(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("tiles")


def op10_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return nbsvm.scored(docs, nbsvm.train(docs, load(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents")).drop("doc_id")


def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    return pieces.digest(pieces.encode(load(spark, sf_dir, "documents"), model), model)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resampled(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_patience_alignment, op2_shape_crf, op3_sum_of_squares_packing, op4_ngram_jaccard, op5_warc_chunk_table,
                                  op6_seed_and_extend, op7_line_labelling,
                                  op8_longest_match_tokens, op9_string_tiling, op10_nb_svm, op11_collocations,
                                  op12_piece_agenda, op13_importance_resampling)}

_OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT p.page_id, strlen(p.h)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(p.sha, (5 * (i // 4) + 1)::BIGINT, 5))::INT // [32768, 1024, 32, 1][i % 4 + 1]) % 32 + 1)::BIGINT,
           1)), 'string_agg', '') AS payload_digest,
       CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p JOIN f USING (h)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11_SQL = f"""
WITH p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w
           FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
                 FROM documents)),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS a
      FROM (SELECT lang, s.size, unnest(list_transform(range(1, len(w) - s.size + 2),
                   lambda i: array_to_string(w[i:i + s.size - 1], ' '))) AS phrase
            FROM p, (SELECT unnest([1, 2, 3, 4]) AS size) s)
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cut AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a // (l.a::HUGEINT + r.a))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inn AS (SELECT lang, a, array_to_string(w[i:i + z - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, size - z + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS z FROM c WHERE size > 2)))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low JOIN tot USING (lang)
WHERE NOT EXISTS (SELECT 1 FROM inn WHERE inn.lang = low.lang AND inn.phrase = low.phrase AND 100::HUGEINT * inn.a >= 80::HUGEINT * low.a)
QUALIFY rank <= 2000
"""

_OP13_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
fd AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
fb AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
bk AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2), lambda i:
                  (instr('0123456789ABCDEF', x[2 * i + 1]) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 17)::BIGINT)),
              lambda c, v: xor(c >> 8, tbl[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, crc),
s AS (SELECT bucket, count(*) AS s FROM fd JOIN bk USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM fb JOIN bk USING (f) GROUP BY bucket),
g AS (SELECT i AS bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
             / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS gain
      FROM range(0, 10000) x(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
m AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
      FROM fd JOIN bk USING (f) JOIN g USING (bucket) GROUP BY doc_id),
z AS (SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                  / 4294967296))))::BIGINT AS score
      FROM d LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_words >= 20)
SELECT z.doc_id, n_features, weight, score,
       CASE WHEN rank <= 25 * (SELECT count(*) FROM r) // 100 THEN rank END AS rank
FROM z LEFT JOIN r USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op5_warc_chunk_table": _OP5_SQL, "op11_collocations": _OP11_SQL,
                              "op13_importance_resampling": _OP13_SQL}
