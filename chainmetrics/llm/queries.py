"""Registered queries of the training-data operators: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmetrics.llm import bpe, chat, collocations, decontam, fim, langid, lattice, mixing, neardup, pii, sharding, suffixes, topk
from chainmetrics.session import ship_package
from chainmetrics.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def byte_bpe_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op4_bpe")
def op4_bpe(t: Tables) -> DataFrame:
    """Encode every whole text with the public byte-level vocabulary and decode it again."""
    return bpe.round_trip(t.documents.select("doc_id", "text"), byte_bpe_file()).drop("text")


#: The shards of the query: 24 of equal weight.
SHARDS = (1.0,) * 24


@register("op5_sharding")
def op5_sharding(t: Tables) -> DataFrame:
    """Weighted rendezvous shards of all documents; one more shard takes rows only into itself."""
    return (sharding.assign(t.documents, SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant turn that both hold control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))


#: The control strings of the template, as an SQL pattern; the formatted text has one more
#: character for each of them and for each backslash of a text.
_CONTROLS = "|".join(re.escape(c) for c in chat.INSTRUCT.controls())


def _escaped_sql(column: str) -> str:
    return f"length({column}) + length({column}) - length(replace({column}, chr(92), '')) + len(regexp_extract_all({column}, '{_CONTROLS}'))"


def _markers_sql() -> str:
    turns = " ".join(f"WHEN '{r}' THEN {len(t.open) + len(t.close)}" for r, t in chat.INSTRUCT.turns.items())
    other = len(chat.INSTRUCT.other.open) + len(chat.INSTRUCT.other.close) + len(chat.INSTRUCT.name_end)
    return f"CASE role {turns} ELSE {other} + {_escaped_sql('role')} END"


def _follows_sql() -> str:
    return "CASE before " + " ".join(
        f"WHEN '{a}' THEN role IN ({', '.join(repr(b) for b in after)})" for a, after in chat.INSTRUCT.follows.items()) + " ELSE false END"


@register("op10_chat", sql=f"""
    WITH rows AS (
           SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
         ordered AS (
           SELECT *, coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w IS NULL AS is_last
           FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum({_markers_sql()} + {_escaped_sql('text')}) AS BIGINT) AS formatted_chars,
           bool_and({_follows_sql()} AND (NOT is_last OR role = 'assistant')) AS order_ok
    FROM ordered GROUP BY conv_id""")
def op10_chat(t: Tables) -> DataFrame:
    """Format all conversations (and the one full of control strings) and read them back."""
    rows = t.conversations.select("conv_id", "turn", "role", "text").unionByName(control_conversation(t.spark))
    return chat.read_back(chat.format_chats(rows))


_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"


@register("op1_decontamination", sql=f"""
    WITH items AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
         sized AS (SELECT item_id, w, least(len(w), 13) AS s FROM items WHERE len(w) > 0),
         windows AS (SELECT DISTINCT item_id, s, w[j:j + s - 1] AS k FROM (SELECT *, unnest(range(1, len(w) - s + 2)) AS j FROM sized)),
         docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
         places AS (SELECT doc_id, s, w[j:j + s - 1] AS k, j
                    FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS j FROM docs, (SELECT DISTINCT s FROM windows))),
         hits AS (SELECT doc_id, j, s, item_id FROM places JOIN windows USING (s, k)),
         counted AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + s)) AS word FROM hits) GROUP BY doc_id),
         listed AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)""")
def op1_decontamination(t: Tables) -> DataFrame:
    """Benchmark passages in every whole document, by winnowing."""
    found = decontam.find_contamination(t.documents.select("doc_id", "text"), t.benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"))


@register("op7_langid")
def op7_langid(t: Tables) -> DataFrame:
    """Language of every whole document, learned outside of the held-out quarter."""
    return langid.identify(t.documents.select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


@register("op8_lm_scoring")
def op8_lm_scoring(t: Tables) -> DataFrame:
    """Base and lattice score of every whole document, learned outside of the held-out seventh."""
    docs = t.documents
    held = langid.remainder("doc_id", 7) == 2
    scored = lattice.score(docs, ~held, byte_bpe_file(), lattice.file_blocks(docs))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "mixed_score")


@register("op6_topk", sql="""
    WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
               FROM embeddings
               WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
               FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""")
def op6_topk(t: Tables) -> DataFrame:
    """Ten highest integer inner products for every hundredth vector, against all vectors."""
    return topk.top_k(t.embeddings, F.col("vec_id") % 100 == 0)


@register("op3_neardup")
def op3_neardup(t: Tables) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85."""
    return neardup.near_duplicates(t.documents)


@register("op9_pii")
def op9_pii(t: Tables) -> DataFrame:
    """Personal data in every whole document: rule matches and spans the boosted trees add."""
    docs = t.documents.select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(spans, kind):
        return F.filter(spans, lambda s: s["kind"] == kind)

    base = F.filter("pii", lambda s: s["base"])  # spans come by kind as listed, then start
    counts = [F.size(of_kind(base, k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


@register("op2_suffix_dedup")
def op2_suffix_dedup(t: Tables) -> DataFrame:
    """Remove every byte of the documents that lies in a 100-byte string which starts earlier, too."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffixes.remove_repeats(t.documents).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


_FIM_CUT = "CAST('0x' || substr(h, {}, 8) AS UBIGINT) % (n + 1)"
_FIM_PLAIN = "t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 >= 100"


@register("op11_fill_in_middle", sql=f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
         u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l FROM d),
         c AS (SELECT *, len(l) AS n FROM u),
         k AS (SELECT *, least({_FIM_CUT.format(1)}, {_FIM_CUT.format(9)}) AS a, greatest({_FIM_CUT.format(1)}, {_FIM_CUT.format(9)}) AS b FROM c),
         f AS (SELECT doc_id, t, n, array_to_string(l[:CAST(a AS INT)], '') AS p, array_to_string(l[CAST(a AS INT) + 1:CAST(b AS INT)], '') AS m,
                      array_to_string(l[CAST(b AS INT) + 1:], '') AS s,
                      CASE WHEN {_FIM_PLAIN} THEN 'plain' WHEN CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
               FROM k)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM f""")
def op11_fill_in_middle(t: Tables) -> DataFrame:
    """Fill-in-the-middle form of every whole document, cut at lines, and the text read back from it."""
    formed = fim.restore(fim.transform(t.documents.select("doc_id", "text")).drop("text"))
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                         F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                         F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


@register("op12_collocations", sql="""
    WITH pieces AS (
           SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
         w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
         sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
         f AS (SELECT lang, s, array_to_string(w[j:j + s - 1], ' ') AS k, count(*) AS c
               FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS j FROM w, (VALUES (1), (2), (3)) AS t(s)) GROUP BY ALL),
         c AS (SELECT lang, s, k, c AS a, string_split(k, ' ') AS e FROM f WHERE s > 1 AND c >= 10),
         longer AS (SELECT lang, k, max(a) AS best
                    FROM (SELECT lang, a, array_to_string(e[1:2], ' ') AS k FROM c WHERE s = 3
                          UNION ALL SELECT lang, a, array_to_string(e[2:3], ' ') FROM c WHERE s = 3) GROUP BY ALL),
         kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, k) WHERE c.s = 3 OR best IS NULL OR 100 * best < 50 * a),
         cuts AS (SELECT lang, s, k, a, i, array_to_string(e[1:i], ' ') AS x, array_to_string(e[i + 1:], ' ') AS y
                  FROM (SELECT *, unnest(range(1, s)) AS i FROM kept)),
         scored AS (SELECT cuts.lang, cuts.k, a, i, x.c AS l, y.c AS r,
                           CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
                    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.k = cuts.x JOIN f y ON y.lang = cuts.lang AND y.k = cuts.y),
         lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k ORDER BY score, i) = 1),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(k)) AS place FROM lowest)
    SELECT lang, place AS rank, k AS phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE place <= 2000""")
def op12_collocations(t: Tables) -> DataFrame:
    """The 2,000 best collocations of two or three words of each language, over all documents."""
    return collocations.mine(t.documents)


@register("op13_mixing")
def op13_mixing(t: Tables) -> DataFrame:
    """The words that a mix of all sources, weighing 5, 2, 1 in turn, takes from every document."""
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    return mixing.mix(t.documents).select("doc_id", "size", "source_size", "target", taken.alias("taken"))
