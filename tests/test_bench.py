"""The benchmark's line."""

import json

import bench
from salesabc.plans import registry

from .conftest import SF_SMALL


def test_landing_has_its_own_figure(spark, monkeypatch, capsys):
    monkeypatch.setenv("BENCH_SF_DIR", SF_SMALL)
    monkeypatch.setattr(bench, "HEADLINE", [])
    monkeypatch.setattr(registry, "_LANDED", {})  # an earlier test may have landed this feed
    bench.main()
    line = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert line["landing_sec"] > 0 and line["value"] == 0
