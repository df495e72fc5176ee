"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``:

1. quality rules: documents that the rules reject go;
2. toxicity: documents with a score of at least ``toxicity.THRESHOLD`` go;
3. n-gram Jaccard join: one document of each group of near duplicates stays;
4. mixing: each source is repeated and cut to its target;
5. SentencePiece encoding: number and digests of the ids of what is left.

A stage that judges texts computes its values once, into a written table of the rows
with their values; the filter then reads that table, and texts do not go to Python again.
Such a table is removed when the next stage begins: by then the result that reads it
is written.

Defined cases, for every stage: null, empty and very long texts are judged whole, as
the operator defines; an empty table gives an empty result of the same columns;
repeated rows are judged row by row (the join keeps one of them); extra columns pass
through the first four stages unchanged, whatever their names, but for those that
begin with two underscores, which belong to the operators, and the names of the quality measures.
"""

from __future__ import annotations

from quarry.llm import ngram_join, piece_bpe, quality_rules, source_mix, toxicity
from quarry.llm.queries import model_path
from quarry.llm.scratch import reading, remove, table, written

_left: list = []    # tables that the last stage's result reads


def _stage(run):
    """A stage that first removes what the one before it left."""
    def stage(spark, docs, sf_dir):
        remove(*_left)
        _left.clear()
        out = run(spark, docs, sf_dir)
        _left.extend(getattr(out, "reads", []))
        return out

    return stage


def quality_stage(spark, docs, sf_dir):
    measured = written(quality_rules.measure(docs), "measured")
    cuts = quality_rules.fit(measured, table(spark, sf_dir, "labels"))
    return reading(quality_rules.judge(measured, cuts).where("kept").select(*docs.columns), measured)


def toxicity_stage(spark, docs, sf_dir):
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), only=~toxicity.held_out())
    scored = written(toxicity.scored(docs, model, name="__toxicity"), "scored")
    return reading(scored.where(scored["__toxicity"] < toxicity.THRESHOLD).select(*docs.columns), scored)


def ngram_stage(spark, docs, sf_dir):
    return ngram_join.one_of_each(docs)


def mixing_stage(spark, docs, sf_dir):
    return source_mix.mixed(docs)


def encoding_stage(spark, docs, sf_dir):
    encoded = written(piece_bpe.digests(docs, model_path()), "encoded")
    return reading(encoded, encoded)


STAGES = [
    ("quality_rules", _stage(quality_stage)),
    ("toxicity", _stage(toxicity_stage)),
    ("ngram_join", _stage(ngram_stage)),
    ("source_mix", _stage(mixing_stage)),
    ("piece_bpe", _stage(encoding_stage)),
]

#: Hashes choose blocks and trained models choose documents: no SQL gives these rows.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
