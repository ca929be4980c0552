"""What the language model leaves on disk."""

import os
import re

from strata.llm import hpylm


def test_language_model_keeps_what_scoring_reads(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b a b c{i % 3} d a b" if i else None) for i in range(40)], "doc_id long, text string")
    key, write, paths = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", hpylm.stage_parts, []

    def noted(*args):
        rows, path = write(*args)
        paths.append(re.sub("^file:/*", "/", path))
        return rows, path

    monkeypatch.setattr(hpylm, "stage_parts", noted)
    was = spark.conf.get(key, None)
    scores = hpylm.score(docs)
    assert spark.conf.get(key, None) == was
    assert len(paths) == 1 + hpylm.BURN_IN + hpylm.SAMPLES
    kinds = {x for at in paths for x in os.listdir(at) if x.startswith("kind=")}
    assert {"kind=model", "kind=about"} <= kinds and not kinds & {"kind=core", "kind=message"}
    assert scores.count() == 40 and scores.where("score > 0 OR score IS NULL").count() == 0
