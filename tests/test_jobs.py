from fixtures import HOURS, write_bronze
from tidemark.__main__ import main
from tidemark.sources.tables import read_gold


def test_jobs_from_bronze_to_catalog(spark, tmp_path, capsys):
    write_bronze(tmp_path / "bronze")
    lake = {k: str(tmp_path / k) for k in ("bronze", "silver", "gold")}
    main(["silver", "--source", lake["bronze"], "--target", lake["silver"], "--datasets", "demanda-real, aporte-hidricos"])
    assert capsys.readouterr().out.startswith("aporte-hidricos: 20 rows\ndemanda-real: ")
    main(["silver", "--source", lake["bronze"], "--target", lake["silver"]])
    main(["gold", "--source", lake["silver"], "--target", lake["gold"], "--keep-incomplete", "--horizon-hours", "2"])
    gold = read_gold(spark, lake["gold"])
    assert gold.count() == HOURS and "label_target_demanda_real_h_plus_2" in gold.columns
    capsys.readouterr()
    main(["catalog", "--root", lake["silver"], "--database", "jobs_test", "--dry-run"])
    assert "create: demanda_real" in capsys.readouterr().out
