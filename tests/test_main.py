from __future__ import annotations

import pytest

from fleetpulse.__main__ import main, parse
from fleetpulse.plans.pipeline import Layers
from fleetpulse.sources.tables import drop_schemas
from tests.test_pipeline import raw_folder


def test_arguments():
    chosen = parse(["gold", "--mode", "append", "--config", '{"zscore_threshold": 3.0}'])
    assert (chosen.layer, chosen.mode, chosen.config) == (
        "gold", "append", {"zscore_threshold": 3.0},
    )
    with pytest.raises(SystemExit):
        parse(["all"])


def test_jobs_hand_over_through_tables(spark, tmp_path):
    layers = Layers()
    root = ["--root", str(tmp_path / "lake")]
    config = ["--config", '{"trees": 10, "max_samples": 64}']
    try:
        main(["bronze", "--raw", raw_folder(tmp_path), *root])
        main(["silver", *root])
        main(["gold", *root, *config])
        once = spark.table(layers.summary).count()
        main(["gold", *root, *config, "--mode", "append"])
        assert spark.table(layers.summary).count() == 2 * once > 0
    finally:
        drop_schemas(spark, layers.bronze, layers.silver, layers.gold)
