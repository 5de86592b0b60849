import json

from ledgerfold.cli import main

from .feed_samples import SCOPE
from .test_contract import GONE, LIVE, listed


def test_collect_validate_publish(spark, tmp_path, capsys):
    (tmp_path / "scope.json").write_text(json.dumps(SCOPE))
    for day, texts in {"2026-07-01": [listed(LIVE.replace("2026-07-14", "2026-07-01"), token="t"), listed()], "2026-07-02": [listed(GONE.replace("2026-07-14", "2026-07-02"))]}.items():
        (tmp_path / "pages" / day).mkdir(parents=True)
        for i, t in enumerate(texts, 1):
            (tmp_path / "pages" / day / f"{i}.xml").write_text(t)
    (tmp_path / "config.json").write_text(json.dumps({"bootstrap_days": 2}))
    root = str(tmp_path / "feed")
    args = ["collect", "--root", root, "--scope", str(tmp_path / "scope.json"), "--config", str(tmp_path / "config.json"), "--pages", str(tmp_path / "pages"), "--today", "2026-07-02", "--generated-at", "2026-07-02T06:00:00Z", "--code-sha", "a" * 40, "--result", str(tmp_path / "result.json")]
    assert main(args, spark) == 0
    artifact = json.loads((tmp_path / "result.json").read_text())
    assert artifact["changed_partitions"] == ["2026-07-01", "2026-07-02"]
    assert main(args, spark) == 0
    assert json.loads((tmp_path / "result.json").read_text())["changed_partitions"] == []
    assert main(["validate", root], spark) == 0
    assert main(["publish", root, str(tmp_path / "copy")], spark) == 0
    (tmp_path / "feed" / "feed.json").write_text("{}\n")
    assert main(["validate", root], spark) == 1
    assert "document_unreadable" in capsys.readouterr().err
