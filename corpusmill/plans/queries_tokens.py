"""Checked queries for vocabulary, encoding, alignment, padding and masking."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..operators import align as AL
from ..operators import encode as E
from ..operators import mask as M
from ..operators import pad as PD
from ..operators import predict as PR
from ..operators import sentences as S
from ..operators import vocab as V
from ..functions.arrays import explode_rows
from ..sources.staging import stage
from ..sources.tables import table, text_table
from . import oracle_tokens as OT
from .oracle_text import q
from .registry import ORACLE, register

SEED = 0
MAX_LEN = 128
TOP_WORDS = 500
IDS = ["article_id", "sent_idx"]


def _kept(spark, sf_dir):
    """Kept sentences."""
    docs = text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "source", "text")
    return S.sentences(S.articles_from_documents(docs), 5, 200)


def _sentences(spark, sf_dir):
    """Kept sentences, persisted: vocabulary and encoding both read them."""
    return _kept(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)


def _vocab(spark, sf_dir, sents=None):
    sents = sents if sents is not None else _sentences(spark, sf_dir)
    return V.fixed_vocab(sents, "text", TOP_WORDS).cache()


def _ints(c):
    # An int array as text is "[1, null, 2]", written without a step per element.
    text = F.col(c).cast("array<int>").cast("string") if isinstance(c, str) else c.cast("array<int>").cast("string")
    return F.replace(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(", "), F.lit(" "))


def _encoded(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    vocab = _vocab(spark, sf_dir, sents)
    return E.encode(sents, IDS, vocab, "text", MAX_LEN), vocab


# ----------------------------------------------------------------- K1
@register("word_counts", f"""
SELECT w AS word, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(regexp_extract_all(text, {OT.WORD}, 0)) AS w FROM documents) GROUP BY w""")
def q_word_counts(spark, sf_dir):
    return V.word_counts(text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text"), "text")


@register("pair_counts", f"""
WITH wc AS (SELECT w AS word, count(*) AS n
            FROM (SELECT unnest(regexp_extract_all(text, {OT.WORD}, 0)) AS w FROM documents) GROUP BY w),
s AS (SELECT n, list_transform(regexp_extract_all(word, {q(V.CHAR)}, 0),
                               lambda c, i: CASE WHEN i = 1 THEN c ELSE '{V.CONT}' || c END) AS syms FROM wc),
p AS (SELECT n, syms[i] AS "left", syms[i + 1] AS "right"
      FROM (SELECT n, syms, unnest(range(1, len(syms))) AS i FROM s WHERE len(syms) > 1))
SELECT "left", "right", CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY 1, 2""")
def q_pair_counts(spark, sf_dir):
    wc = V.word_counts(text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text"), "text")
    return V.pair_counts(wc.select(V.initial_symbols("word").alias("syms"), "n"))


@register("vocab")          # iterative; checked against exact BPE in tests
def q_vocab(spark, sf_dir):
    return V.train_vocab(_kept(spark, sf_dir), "text", vocab_size=20000)       # read once: not persisted


@register("fixed_vocab", f"WITH {OT.sent_cte()},\n{OT.vocab_ctes(TOP_WORDS)}\nSELECT token, id FROM vocab")
def q_fixed_vocab(spark, sf_dir):
    return _vocab(spark, sf_dir)


# ----------------------------------------------------------------- K2, K6, K7
_OCC = """occ AS (SELECT article_id, sent_idx, unnest(ws) AS word, unnest(range(len(ws))) AS widx
        FROM (SELECT article_id, sent_idx, regexp_extract_all(text, {w}, 0) AS ws FROM sent))""".format(w=OT.WORD)
_ENC = f"""WITH RECURSIVE {OT.sent_cte()},
{OT.vocab_ctes(TOP_WORDS)},
{_OCC},
{OT.seg_ctes('occ')},
agg AS (SELECT o.article_id, o.sent_idx, flatten(list(seg.ids ORDER BY o.widx)) AS ids,
               flatten(list(seg.toks ORDER BY o.widx)) AS toks
        FROM occ o JOIN seg ON seg.word = o.word GROUP BY 1, 2),
enc AS (SELECT article_id, sent_idx, CAST(len(ids) AS BIGINT) AS n_pieces,
               list_concat([2], ids[1:{MAX_LEN - 2}], [3]) AS input_ids,
               list_concat(['[CLS]'], toks[1:{MAX_LEN - 2}], ['[SEP]']) AS toks FROM agg)
"""


@register("encode", _ENC + f"SELECT article_id, sent_idx, n_pieces, {OT.ints('input_ids')} AS input_ids FROM enc")
def q_encode(spark, sf_dir):
    enc, _ = _encoded(spark, sf_dir)
    return enc.select(*IDS, "n_pieces", _ints("input_ids").alias("input_ids"))


@register("ids_to_tokens", _ENC + "SELECT article_id, sent_idx, array_to_string(toks, ' ') AS tokens FROM enc")
def q_ids_to_tokens(spark, sf_dir):
    enc, vocab = _encoded(spark, sf_dir)
    t = E.ids_to_tokens(enc, IDS, "input_ids", vocab)
    return t.select(*IDS, F.array_join("tokens", " ").alias("tokens"))


@register("decode", _ENC + f"SELECT article_id, sent_idx, {OT.text_of('toks')} AS text FROM enc")
def q_decode(spark, sf_dir):
    enc, vocab = _encoded(spark, sf_dir)
    return E.decode(enc, IDS, "input_ids", vocab, skip_special_tokens=True)


@register("token_lengths", _ENC + """SELECT CAST(len(input_ids) AS BIGINT) AS n_tokens,
       CAST(count(*) AS BIGINT) AS n_rows FROM enc GROUP BY 1""")
def q_token_lengths(spark, sf_dir):
    enc, _ = _encoded(spark, sf_dir)
    return (enc.groupBy(F.size("input_ids").cast("bigint").alias("n_tokens"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


@register("pad_fixed", _ENC + f"""SELECT article_id, sent_idx,
       {OT.ints(OT.pad_cut('input_ids', 32, '0'))} AS input_ids FROM enc""")
def q_pad_fixed(spark, sf_dir):
    enc, _ = _encoded(spark, sf_dir)
    return enc.select(*IDS, _ints(E.pad_or_cut("input_ids", 32, E.PAD_ID)).alias("input_ids"))


# ----------------------------------------------------------------- K13
BATCH = 8


@register("pad_batch", _ENC + f""", b AS (SELECT *, CAST((row_number() OVER (ORDER BY k, article_id, sent_idx) - 1)
                               // {BATCH} AS BIGINT) AS batch
          FROM (SELECT *, md5(CAST(article_id AS VARCHAR) || ':' || CAST(sent_idx AS VARCHAR)) AS k FROM enc))
SELECT article_id, sent_idx, batch, CAST(max(len(input_ids)) OVER (PARTITION BY batch) AS BIGINT) AS padded_len
FROM b""")
def q_pad_batch(spark, sf_dir):
    enc, _ = _encoded(spark, sf_dir)
    keyed = enc.withColumn("k", F.md5(F.concat_ws(":", F.col("article_id").cast("string"),
                                                  F.col("sent_idx").cast("string"))))
    b = PD.batch_ids(keyed, ["k", "article_id", "sent_idx"], BATCH)
    return PD.pad_batches(b).select(*IDS, "batch", "padded_len")


# ----------------------------------------------------------------- K14, K15
def _u_sql(nth):
    return (f"CAST(('0x' || substr(md5('{SEED}:' || CAST(article_id AS VARCHAR) || ':' || CAST(sent_idx AS VARCHAR)"
            f" || ':' || CAST(i - 1 AS VARCHAR)), {8 * nth + 1}, 8)) AS BIGINT)")


_CHOSEN = f"(x >= {len(V.SPECIALS)} AND {_u_sql(0)} < {0.15 * M.SCALE!r})"
_MASKED = f"""list_transform(input_ids, lambda x, i: CASE WHEN {_CHOSEN} THEN
      (CASE WHEN {_u_sql(1)} < {0.8 * M.SCALE!r} THEN {V.MASK_ID}
            WHEN {_u_sql(1)} < {0.9 * M.SCALE!r}
            THEN CAST({_u_sql(2)} % (nv - {len(V.SPECIALS)}) + {len(V.SPECIALS)} AS INTEGER)
            ELSE x END) ELSE x END)"""
_LABELS = f"list_transform(input_ids, lambda x, i: CASE WHEN {_CHOSEN} THEN x ELSE -100 END)"


def _mask_rows(enc, vocab):
    key = F.concat_ws(":", F.col("article_id").cast("string"), F.col("sent_idx").cast("string"))
    return M.mlm_mask(enc, key, "input_ids", vocab.count(), 0.15, SEED)


def _masked(spark, sf_dir):
    enc, vocab = _encoded(spark, sf_dir)
    return _mask_rows(enc, vocab), vocab


@register("mlm_mask", _ENC + f"""SELECT article_id, sent_idx, {OT.ints(_MASKED)} AS masked_ids,
       {OT.ints(_LABELS)} AS mlm_labels FROM enc, (SELECT count(*) AS nv FROM vocab) nvt""")
def q_mlm_mask(spark, sf_dir):
    m, _ = _masked(spark, sf_dir)
    return m.select(*IDS, _ints("masked_ids").alias("masked_ids"), _ints("mlm_labels").alias("mlm_labels"))


@register("mask_view", _ENC + f""", mk AS (SELECT article_id, sent_idx, toks, {_MASKED} AS m
                     FROM enc, (SELECT count(*) AS nv FROM vocab) nvt),
mu AS (SELECT article_id, sent_idx, unnest(m) AS id, unnest(range(len(m))) AS pos FROM mk),
mt AS (SELECT mu.article_id, mu.sent_idx, list(coalesce(v.token, '[UNK]') ORDER BY mu.pos) AS mtoks
       FROM mu LEFT JOIN vocab v ON v.id = mu.id GROUP BY 1, 2)
SELECT mk.article_id, mk.sent_idx,
       replace(array_to_string(mk.toks[2:len(mk.toks) - 1], ' '), ' {V.CONT}', '') AS original,
       replace(array_to_string(mt.mtoks[2:len(mt.mtoks) - 1], ' '), ' {V.CONT}', '') AS masked
FROM mk JOIN mt ON mt.article_id = mk.article_id AND mt.sent_idx = mk.sent_idx""")
def q_mask_view(spark, sf_dir):
    m, vocab = _masked(spark, sf_dir)
    return M.mask_view(m, IDS, vocab)


@register("mask_predict", _ENC + f""", near AS (SELECT p, q, count(*) AS n
     FROM (SELECT unnest(input_ids[1:len(input_ids) - 1]) AS p, unnest(input_ids[2:]) AS q FROM enc)
     WHERE q >= {len(V.SPECIALS)} GROUP BY 1, 2),
follow AS (SELECT p, arg_min(q, (-n, q)) AS g FROM near GROUP BY p),
most AS (SELECT arg_min(q, (-n, q)) AS g FROM (SELECT q, sum(n) AS n FROM near GROUP BY q)),
guess AS (SELECT list(coalesce(follow.g, most.g) ORDER BY v.id) AS gs FROM vocab v LEFT JOIN follow ON follow.p = v.id, most),
mk AS (SELECT article_id, sent_idx, toks, input_ids, {_MASKED} AS m, {_LABELS} AS y
       FROM enc, (SELECT count(*) AS nv FROM vocab) nvt),
pr AS (SELECT *, list_transform(m, lambda x, i: CASE WHEN y[i] <> -100 THEN gs[m[i - 1] + 1] ELSE x END) AS g FROM mk, guess),
mu AS (SELECT article_id, sent_idx, unnest(m) AS mi, unnest(g) AS gi, unnest(y) AS yi, unnest(range(len(m))) AS pos FROM pr),
mt AS (SELECT mu.article_id, mu.sent_idx, list(coalesce(a.token, '[UNK]') ORDER BY pos) AS mtoks,
              list(coalesce(b.token, '[UNK]') ORDER BY pos) AS gtoks,
              CAST(count(*) FILTER (yi <> -100) AS BIGINT) AS n_masked, CAST(count(*) FILTER (yi = gi) AS BIGINT) AS n_right
       FROM mu LEFT JOIN vocab a ON a.id = mu.mi LEFT JOIN vocab b ON b.id = mu.gi GROUP BY 1, 2)
SELECT mk.article_id, mk.sent_idx, n_masked, n_right,
       replace(array_to_string(mk.toks[2:len(mk.toks) - 1], ' '), ' {V.CONT}', '') AS original,
       replace(array_to_string(mtoks[2:len(mtoks) - 1], ' '), ' {V.CONT}', '') AS masked,
       replace(array_to_string(gtoks[2:len(gtoks) - 1], ' '), ' {V.CONT}', '') AS predicted
FROM mk JOIN mt ON mt.article_id = mk.article_id AND mt.sent_idx = mk.sent_idx""")
def q_mask_predict(spark, sf_dir):
    """K15 with its prediction column: the most frequent follower of the token before."""
    # Sentences and ids are read twice each: stored, so that neither is made again or fills the executors' memory.  Masked
    # rows are stored too: one task would run a Python worker for each of masking, guessing and naming at once.
    sents = stage(_kept(spark, sf_dir), "sentences")
    vocab = _vocab(spark, sf_dir, sents)
    enc = stage(E.encode(sents, IDS, vocab, "text", MAX_LEN).select(*IDS, "input_ids"), "encoded")
    m = stage(_mask_rows(enc, vocab).select(*IDS, "input_ids", "masked_ids", "mlm_labels"), "masked")
    p = PR.predict_masked(m, PR.next_token_table(enc), vocab.count())
    z = F.arrays_zip(F.col("mlm_labels").alias("y"), F.col("predicted_ids").alias("g"))
    p = p.select("*", F.size(F.filter("mlm_labels", lambda y: y != M.NULL_LABEL)).cast("bigint").alias("n_masked"),
                 F.size(F.filter(z, lambda x: x["y"] == x["g"])).cast("bigint").alias("n_right"))
    return M.mask_view(p, [*IDS, "n_masked", "n_right"], vocab, predicted_col="predicted_ids")


# ----------------------------------------------------------------- K3
_PAIRS_SQL = """pairs AS (SELECT a.conv_id, a.turn, a.text AS sentence1, b.text AS sentence2
          FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
          WHERE a.role = 'user')"""


def _pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    a = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("sentence1"))
    b = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sentence2"))
    return a.join(b, ["conv_id", "turn"])       # S6: a user turn and the turn after it


@register("sentence_pairs", f"WITH {_PAIRS_SQL} SELECT conv_id, turn, sentence1, sentence2 FROM pairs")
def q_sentence_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@register("encode_pairs", f"""WITH RECURSIVE {OT.sent_cte()},
{OT.vocab_ctes(TOP_WORDS)},
{_PAIRS_SQL},
po AS (SELECT conv_id, turn, side, unnest(ws) AS word, unnest(range(len(ws))) AS widx
       FROM (SELECT conv_id, turn, 0 AS side, regexp_extract_all(sentence1, {OT.WORD}, 0) AS ws FROM pairs
             UNION ALL
             SELECT conv_id, turn, 1 AS side, regexp_extract_all(sentence2, {OT.WORD}, 0) AS ws FROM pairs)),
{OT.seg_ctes('po')},
ag AS (SELECT p.conv_id, p.turn,
              coalesce(flatten(list(seg.ids ORDER BY po.widx) FILTER (WHERE po.side = 0)), []) AS a,
              coalesce(flatten(list(seg.ids ORDER BY po.widx) FILTER (WHERE po.side = 1)), []) AS b
       FROM pairs p LEFT JOIN po ON po.conv_id = p.conv_id AND po.turn = p.turn
       LEFT JOIN seg ON seg.word = po.word GROUP BY 1, 2),
tr AS (SELECT *, CASE WHEN len(a) + len(b) > {MAX_LEN - 3}
                 THEN least(len(a), greatest({MAX_LEN - 3} - len(b), {(MAX_LEN - 2) // 2})) ELSE len(a) END AS na
       FROM ag),
tr2 AS (SELECT *, CASE WHEN len(a) + len(b) > {MAX_LEN - 3} THEN {MAX_LEN - 3} - na ELSE len(b) END AS nb FROM tr)
SELECT conv_id, turn, {OT.ints(f"list_concat([2], a[1:na], [3], b[1:nb], [3])")} AS input_ids,
       {OT.ints("list_concat(list_transform(range(na + 2), lambda e: 0), list_transform(range(nb + 1), lambda e: 1))")}
       AS token_type_ids
FROM tr2""")
def q_encode_pairs(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    vocab = _vocab(spark, sf_dir, sents)
    enc = E.encode_pairs(_pairs(spark, sf_dir), ["conv_id", "turn"], vocab, max_length=MAX_LEN)
    return enc.select("conv_id", "turn", _ints("input_ids").alias("input_ids"),
                      _ints("token_type_ids").alias("token_type_ids"))


# ----------------------------------------------------------------- S5, K8-K12, P12
_TAGS = ("lambda w: CASE WHEN regexp_matches(w, '^[A-Z]') THEN 1 "
         "WHEN regexp_matches(w, '^[0-9]+$') THEN 2 ELSE 0 END")
_TT = f"""tt AS (SELECT article_id, sent_idx, regexp_extract_all(text, {OT.WORD}, 0) AS tokens FROM sent),
tt2 AS (SELECT *, list_transform(tokens, {_TAGS}) AS tags FROM tt)"""


@register("tagged_tokens", f"""WITH {OT.sent_cte()},
{_TT}
SELECT article_id, sent_idx, array_to_string(tokens, ' ') AS tokens, {OT.ints('tags')} AS ner_tags FROM tt2""")
def q_tagged_tokens(spark, sf_dir):
    t = AL.tagged_tokens(_sentences(spark, sf_dir), IDS)
    return t.select(*IDS, F.array_join("tokens", " ").alias("tokens"), _ints("ner_tags").alias("ner_tags"))


@register("num_classes", f"""WITH {OT.sent_cte()},
{_TT}
SELECT CAST(count(DISTINCT t) AS BIGINT) AS num_classes FROM (SELECT unnest(tags) AS t FROM tt2)""")
def q_num_classes(spark, sf_dir):
    t = AL.tagged_tokens(_sentences(spark, sf_dir), IDS)
    return explode_rows(t, [], F.col("ner_tags"), "t").agg(
        F.countDistinct("t").cast("bigint").alias("num_classes"))


_ALIGN = f"""WITH RECURSIVE {OT.sent_cte()},
{OT.vocab_ctes(TOP_WORDS)},
{_TT},
o AS (SELECT article_id, sent_idx, unnest(tokens) AS word, unnest(tags) AS tag, unnest(range(len(tokens))) AS wi
      FROM tt2),
{OT.seg_ctes('o')},
p AS (SELECT o.*, seg.ids, seg.toks FROM o JOIN seg ON seg.word = o.word),
ag AS (SELECT article_id, sent_idx, flatten(list(ids ORDER BY wi)) AS ids,
              flatten(list(list_transform(ids, lambda e: wi) ORDER BY wi)) AS wids,
              flatten(list(list_concat([tag], list_transform(ids[2:], lambda e: -100)) ORDER BY wi)) AS labs,
              flatten(list(toks ORDER BY wi)) AS toks
       FROM p GROUP BY 1, 2),
al AS (SELECT article_id, sent_idx,
              {OT.pad_cut('list_concat([2], ids, [3])', MAX_LEN, '0')} AS input_ids,
              {OT.pad_cut('list_concat([NULL], wids, [NULL])', MAX_LEN, 'CAST(NULL AS BIGINT)')} AS word_ids,
              {OT.pad_cut('list_concat([-100], labs, [-100])', MAX_LEN, '-100')} AS labels,
              {OT.pad_cut('list_transform(range(len(ids) + 2), lambda e: 1)', MAX_LEN, '0')} AS attention_mask,
              {OT.pad_cut("list_concat(['[CLS]'], toks, ['[SEP]'])", MAX_LEN, "'[PAD]'")} AS toks
       FROM ag)
"""


def _aligned(spark, sf_dir):
    sents = _sentences(spark, sf_dir)
    vocab = _vocab(spark, sf_dir, sents)
    t = AL.tagged_tokens(sents, IDS)
    return AL.align_labels(t, IDS, vocab, max_length=MAX_LEN)


@register("ner_align", _ALIGN + f"""SELECT article_id, sent_idx, {OT.ints('input_ids')} AS input_ids,
       {OT.ints('word_ids')} AS word_ids, {OT.ints('labels')} AS labels,
       {OT.ints('attention_mask')} AS attention_mask, {OT.text_of('toks')} AS text FROM al""")
def q_ner_align(spark, sf_dir):
    a = _aligned(spark, sf_dir)
    return a.select(*IDS, *[_ints(c).alias(c) for c in ("input_ids", "word_ids", "labels", "attention_mask")],
                    "text")


@register("entities_from_tags", _ALIGN + f""", tg AS (SELECT article_id, sent_idx, tags FROM tt2),
pr AS (SELECT al.article_id, al.sent_idx, al.word_ids, al.attention_mask, tt.tokens AS words,
              list_transform(al.word_ids, lambda w: coalesce(tg.tags[w + 1], 0)) AS pred
       FROM al JOIN tg ON tg.article_id = al.article_id AND tg.sent_idx = al.sent_idx
       JOIN tt ON tt.article_id = al.article_id AND tt.sent_idx = al.sent_idx),
vl AS (SELECT *, CASE WHEN word_ids[len(attention_mask)] IS NOT NULL THEN list_sum(attention_mask) - 1
                      ELSE list_sum(attention_mask) - 2 END AS valid FROM pr),
ex AS (SELECT article_id, sent_idx, words, unnest(pred) AS p, unnest(word_ids) AS w,
              unnest(range(len(pred))) AS pos, valid FROM vl),
f AS (SELECT article_id, sent_idx, coalesce(words[w + 1], '[INV]') AS word, CAST(pos - 1 AS BIGINT) AS pos, p
      FROM ex WHERE pos >= 1 AND pos <= valid AND p <> 0)
SELECT article_id, sent_idx, word, min(pos) AS first_pos,
       array_to_string(list(CAST(p AS VARCHAR) ORDER BY pos), ' ') AS tags
FROM f GROUP BY 1, 2, 3""")
def q_entities_from_tags(spark, sf_dir):
    from ..operators.metrics import entities
    sents = _sentences(spark, sf_dir)
    vocab = _vocab(spark, sf_dir, sents)
    t = AL.tagged_tokens(sents, IDS)
    a = AL.align_labels(t, IDS, vocab, max_length=MAX_LEN, keep_tags=True)
    # a perfect tagger: every piece gets its word's tag, specials and padding 0
    pred = F.transform("word_ids", lambda w: F.coalesce(F.try_element_at("ner_tags", w + 1), F.lit(0)))
    e = entities(a.withColumn("pred", pred), IDS)
    return e.select(*IDS, "word", F.col("first_pos").cast("bigint").alias("first_pos"),
                    F.array_join(F.transform("tags", lambda x: x.cast("string")), " ").alias("tags"))


for _n in ("encode", "ids_to_tokens", "decode", "token_lengths", "pad_fixed", "pad_batch", "mlm_mask",
           "mask_view"):
    assert ORACLE[_n].startswith("WITH RECURSIVE")
