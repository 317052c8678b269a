"""Articles -> anonymized splits -> learned vocabulary -> encoded -> masked rows.

The data side of masked-language-model training as one job of four stored stages
(F10 -> K1 -> K2 -> K14).  Each stage reads what the one before it wrote, so lineage
ends there, a lost executor costs a re-read, and a second run with the same parameters
reads every stage; a changed parameter rebuilds its stage and those after it (S10).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import encode as E
from ..operators import mask as M
from ..operators import pii as PII
from ..operators import vocab as V
from ..sources.versioned import Output, build_or_read
from .build_splits import build_splits

IDS = ["split", "article_id", "sent_idx"]


@dataclass
class Pretraining:
    sentences: Output        # split, article_id, sent_idx, text (anonymized)
    vocab: Output            # token, id, kind
    encoded: Output          # IDS, n_pieces, input_ids, token_type_ids, attention_mask
    masked: Output           # IDS, input_ids, masked_ids, mlm_labels


def prepare_pretraining(articles: DataFrame, root: str, source: str, budgets_mib: dict | None = None,
                        shares: dict | None = None, seed: int = 0, min_spaces: int | None = 5,
                        max_spaces: int | None = 200, tags=P.DEFAULT_TAGS, vocab_size: int = 20000,
                        max_length: int | None = 128, probability: float = 0.15, train: str = "train",
                        force_rebuild: bool = False) -> Pretraining:
    """Run, or read again, all stages under ``root``.

    ``source`` names the articles (a path and version): it is part of every fingerprint, since rows
    themselves are not compared.  The vocabulary is learned on the anonymized ``train`` split only.
    """
    spark = articles.sparkSession

    def anonymized():
        b = build_splits(articles, budgets_mib, True, seed, min_spaces, max_spaces, shares=shares)
        return PII.anonymize_text(b.sentences, "text", None, tags=tags, seed=seed).select(*IDS, "text")

    sentences = build_or_read(spark, root, "sentences", dict(
        source=source, budgets=budgets_mib, shares=shares, seed=seed, spaces=[min_spaces, max_spaces], tags=list(tags)),
        anonymized, force_rebuild=force_rebuild, partition_by=("split",))
    # The split column is in the folder names, so the train split is read alone.
    vocab = build_or_read(
        spark, root, "vocab", dict(vocab_size=vocab_size, train=train),
        lambda: V.train_vocab(sentences.rows.where(F.col("split") == train), "text", vocab_size).coalesce(1),
        (sentences.version,), sentences.built)
    encoded = build_or_read(
        spark, root, "encoded", dict(max_length=max_length),
        lambda: E.encode(sentences.rows, IDS, vocab.rows, "text", max_length),
        (sentences.version, vocab.version), vocab.built, ("split",))

    def masked_rows():
        key = F.concat_ws(":", *[F.col(c).cast("string") for c in IDS])
        n = vocab.rows.count()
        return M.mlm_mask(encoded.rows, key, "input_ids", n, probability, seed).select(
            *IDS, "input_ids", "masked_ids", "mlm_labels")

    masked = build_or_read(spark, root, "masked", dict(probability=probability, seed=seed), masked_rows,
                           (encoded.version,), encoded.built, ("split",))
    return Pretraining(sentences, vocab, encoded, masked)


def restored_text(p: Pretraining) -> DataFrame:
    """IDS and the text that the masked rows stand for: masked ids replaced by their
    labels, decoded with the stored vocabulary."""
    ids = F.zip_with("masked_ids", "mlm_labels", lambda m, y: F.when(y == M.NULL_LABEL, m).otherwise(y))
    rows = p.masked.rows.select(*IDS, ids.alias("ids"))
    return E.decode(rows, IDS, "ids", p.vocab.rows)
