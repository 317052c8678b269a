"""Checked query for the pretraining chain (F10 -> K1 -> K2 -> K14)."""

from __future__ import annotations

from ..functions import patterns as P
from ..operators.vocab import CHAR, CONT
from ..session import checkpoint_dir
from . import oracle_pii as OP
from . import oracle_tokens as OT
from .build_splits import WHOLE_SHARES
from .oracle_text import q
from .pretrain import prepare_pretraining, restored_text
from .queries_splits import SEED, _articles, _split_sql
from .registry import register

VOCAB_SIZE = 20000

# Whatever merges were learned, restoring and decoding the masked rows gives the words of the
# anonymized text back, but for words with a symbol that the train split does not hold.
_SYMBOLS = (f"list_transform(regexp_extract_all({{w}}, {q(CHAR)}, 0), "
            f"lambda c, i: CASE WHEN i = 1 THEN c ELSE '{CONT}' || c END)")

_SQL = _split_sql() + """, src AS (SELECT split || ':' || CAST(article_id AS VARCHAR) || ':' || CAST(sent_idx AS VARCHAR) AS _k,
                split, article_id, sent_idx, text, 'en' AS lang FROM d),""" + OP.anonymize_ctes(P.DEFAULT_TAGS, 20, SEED) + f""",
ws AS (SELECT src.split, src.article_id, src.sent_idx, regexp_extract_all(anon.text, {OT.WORD}, 0) AS words
       FROM src JOIN anon ON anon._k = src._k),
alphabet AS (SELECT list(DISTINCT s) AS known FROM (SELECT unnest({_SYMBOLS.format(w='w')}) AS s FROM
             (SELECT DISTINCT unnest(words) AS w FROM ws WHERE split = 'train')))
SELECT split, article_id, sent_idx, array_to_string(list_filter(words, lambda w: list_has_all(
       known, {_SYMBOLS.format(w='w')})), ' ') AS text
FROM ws, (SELECT coalesce(max(known), []) AS known FROM alphabet) a"""


@register("pretrain_chain", _SQL)
def q_pretrain_chain(spark, sf_dir):
    p = prepare_pretraining(_articles(spark, sf_dir), f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-pretrain", sf_dir,
                            shares=WHOLE_SHARES, seed=SEED, vocab_size=VOCAB_SIZE, max_length=None)
    return restored_text(p)
