"""Fit the small stored model (chainsight/models/risk_small.json) on the training rows of sf0.001."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chainsight.operators import ml as M  # noqa: E402
from chainsight.operators import trees as TR  # noqa: E402
from chainsight.plans import catalog as E  # noqa: E402
from chainsight.session import local_session  # noqa: E402

PARAMS = {"maxIter": 5, "maxDepth": 3}

if __name__ == "__main__":
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark = local_session(4)
    frame = M.model_frame(E.silver(spark, "/root/testdata/sf0.001"))
    train, _ = M.train_test_split(frame)
    TR.extract(M.fit(spark, train, params=PARAMS)).save(f"{root}/chainsight/models/risk_small.json")
