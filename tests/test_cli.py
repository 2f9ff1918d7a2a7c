import pytest

from casetrace.cli import main
from casetrace.sources.case_feed import write_case_feed
from casetrace.sources.tables import read_model

from feed_rows import records


def test_cli_load_build_report(spark, scratch, capsys):
    write_case_feed(records(spark, {}, {"person_given": "Eva"}), f"{scratch}/feed")
    assert main(["load", "--feed", f"{scratch}/feed", "--staged", f"{scratch}/staged"]) == 0
    assert main(["build", "--staged", f"{scratch}/staged", "--model", f"{scratch}/model"]) == 0
    assert read_model(spark, f"{scratch}/model").person.count() == 2
    assert main(["report", "r9", "--model", f"{scratch}/model"]) == 0
    assert main(["report", "r5", "--model", f"{scratch}/model", "--param", "k=1",
                 "--param", "description=Oxygen", "--out", f"{scratch}/r5"]) == 0
    assert spark.read.parquet(f"{scratch}/r5").count() == 1
    out = capsys.readouterr().out
    assert "North" in out


def test_cli_report_literals_are_required(spark, scratch):
    with pytest.raises(SystemExit):
        main(["report", "r1", "--model", f"{scratch}/none"])
