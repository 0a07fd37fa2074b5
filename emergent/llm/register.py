"""The thin queries of the training-data operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emergent.llm import (ann, decontaminate, infill, langid, lm, packing, phrases, pii, records, simhash, substrings,
                          tokens, urlrules, warc)
from emergent.llm.common import Scratch, text_bytes

#: Ids appended to a document's own: in the record files, and in packed sequences.
RECORD_END, PACK_END = 1, 2


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def op1_token_records(spark: SparkSession, d: str) -> DataFrame:
    """Tokenize, write record files and their index, read the files back."""
    scratch = Scratch(spark, "records")
    index = records.write_records(_table(spark, d, "documents"), scratch, vocabulary=tokens.public_path(),
                                  end_id=RECORD_END)
    back = records.read_records(index)
    return back.select(F.col("id").alias("doc_id"), "start",
                       (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    """Score all documents with a model of those that are not held out."""
    docs, scratch = _table(spark, d, "documents"), Scratch(spark, "lm")
    out = langid.held_out("doc_id", 7)
    model, table = lm.train(docs.filter(~out).select(text_bytes("text").alias("text")), scratch)
    return lm.score(docs, model, table, scratch, {"doc_id": F.col("doc_id"), "held_out": out})


def _joined(spans: str) -> Column:
    """``kind:start:end`` by start, then kind as listed (the operator's order), comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op3_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data by patterns and by the semi-Markov field trained around their matches."""
    docs = _table(spark, d, "documents")
    found = pii.find(docs, pii.train(docs))
    counts = [_count("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark passage: five-word shingles, similarity of 0.8 or more."""
    return decontaminate.contaminated(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op5_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20, among all others."""
    return ann.nearest(_table(spark, d, "embeddings"), k=20, is_query=F.col("vec_id") % 20 == 0)


def op6_language(spark: SparkSession, d: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs, scratch = _table(spark, d, "documents"), Scratch(spark, "langid")
    model = langid.train(docs.filter(~langid.held_out("doc_id")), scratch)
    # The remainder is a function of the id alone, so it is added beside the prediction.
    return langid.predict(docs, model).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_substrings(spark: SparkSession, d: str) -> DataFrame:
    """Remove every 100-byte string that also starts earlier."""
    out = substrings.deduplicated(_table(spark, d, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, d: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 ids."""
    out = packing.packed(_table(spark, d, "documents"), vocabulary=tokens.public_path(), end_id=PACK_END, window=4096)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset")


def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    """Write an archive record per page, read all archives back through the index."""
    scratch = Scratch(spark, "warc")
    back = warc.read_archives(warc.write_archives(_table(spark, d, "pages"), scratch))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hex FROM p),
d AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
  array_to_string(list_transform(range(0, 40, 5), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, i + 1, 5))::INT >> 15) & 31)::INT, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, i + 1, 5))::INT >> 10) & 31)::INT, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, i + 1, 5))::INT >> 5) & 31)::INT, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hex, i + 1, 5))::INT & 31)::INT, 1)), '')
    AS payload_digest FROM h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two or fewer differing bits."""
    return simhash.near_duplicates(_table(spark, d, "documents"), shingle=3, distance=2)


def op11_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Each language's 2000 best phrases of two to four words that occur 30 times or more."""
    return phrases.collocations(_table(spark, d, "documents"), longest=4, least=30, top=2000)


OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
  AS phrase FROM w, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, v.i, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
  FROM c JOIN (VALUES (1), (2), (3)) v(i) ON v.i < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:v.i], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[v.i + 1:c.k], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (SELECT c.lang, array_to_string(c.w[s.i:s.i + z.size - 1], ' ') AS phrase, max(c.a) AS holder
  FROM c JOIN (VALUES (2), (3)) z(size) ON z.size < c.k JOIN (VALUES (1), (2), (3)) s(i) ON s.i + z.size - 1 <= c.k
  GROUP BY ALL),
best AS (SELECT k.*, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase) AS rank
  FROM weakest k LEFT JOIN inside i ON i.lang = k.lang AND i.phrase = k.phrase
  WHERE coalesce(100 * i.holder < 80 * k.a, true))
SELECT best.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM best JOIN n USING (lang) WHERE rank <= 2000
"""

#: Host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op12_url_rules(spark: SparkSession, d: str) -> DataFrame:
    """The verdict of the longest rule that fits each page's url; urls without one are allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judged(_table(spark, d, "pages"), rules, default="allow")


OP12_SQL = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
u AS (SELECT row_number() OVER () AS row, page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(rhost || rpath) DESC) = 1
"""


def op13_infill(spark: SparkSession, d: str) -> DataFrame:
    """Fill-in-middle over lines, half of the documents suffix first, and the texts rebuilt from it."""
    out = infill.transformed(_table(spark, d, "documents").select("doc_id", "text"), seed=7, fim_percent=100,
                             spm_percent=50)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(infill.restored("form", "output"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS x FROM d),
c AS (SELECT *, least(x[1] % (n + 1), x[2] % (n + 1)) AS i, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS j,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x[3] % 100 >= 100
  THEN 'plain' WHEN x[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, coalesce(array_to_string(u[1:i], ''), '') AS prefix, coalesce(array_to_string(u[i + 1:j], ''), '') AS middle,
  coalesce(array_to_string(u[j + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def shipped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The same function, after which Python workers find the package where this process found it."""

    def query(spark: SparkSession, *args: object) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        env = spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
        return fn(spark, *args)

    query.__doc__, query.__name__ = fn.__doc__, fn.__name__
    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: shipped(f) for f in (
    op1_token_records, op2_lm_scores, op3_pii, op4_decontamination, op5_nearest, op6_language, op7_substrings, op8_packing, op9_warc, op10_simhash,
    op11_phrases, op12_url_rules, op13_infill)}


def oracle_sql() -> dict[str, str]:
    return {"op9_warc": OP9_SQL, "op11_phrases": OP11_SQL, "op12_url_rules": OP12_SQL, "op13_infill": OP13_SQL}
