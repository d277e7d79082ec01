"""The command line runs a suite from parquet folders and copies objects."""

import os

from recount.__main__ import main
from recount.plans.extracts import auth


def test_report_auth_suite_from_parquet(spark, cat, tmp_path, capsys):
    src, dst, out = tmp_path / "legacy", tmp_path / "auth_db", tmp_path / "reports"
    for t in ("spree_users", "spree_user_authentications", "spree_user_clients", "spree_roles", "spree_roles_users"):
        cat[t].write.parquet(str(src / f"{t}.parquet"))
    auth.auth_user(cat).write.parquet(str(dst / "public.user.parquet"))
    auth.device_token(cat).limit(3).write.parquet(str(dst / "device_token.parquet"))
    auth.auth_employee(cat).write.parquet(str(dst / "employee.parquet"))
    status = main(["report", "--suite", "auth", "--source-parquet", str(src), "--dest-parquet", str(dst),
                   "--out", str(out)])
    printed = capsys.readouterr().out
    assert status == 1  # device_token lost rows
    assert "Number of records not migrated : 13" in printed
    rows = spark.read.option("header", True).csv(str(out / "auth_db")).collect()
    assert [r["Result"] for r in rows] == ["count matches", "count mismatch", "count matches"]


def test_report_of_missing_tables_fails(spark, tmp_path, capsys):
    for policy in ("stop", "isolate"):
        status = main(["report", "--suite", "auth", "--source-parquet", str(tmp_path / "no"), "--dest-parquet", str(tmp_path / "none"),
                       "--on-error", policy])
        printed = capsys.readouterr().out
        assert status == 1 and "spree_users" in printed and "count mismatch" in printed


def test_partition_arguments():
    from recount.__main__ import _partitioning

    got = _partitioning(["spree_orders=id:64", "spree_users=id"])
    assert (got["spree_orders"].column, got["spree_orders"].num_partitions, got["spree_users"].num_partitions) == ("id", 64, 200)


def test_copy_command(spark, tmp_path, capsys):
    src, dst = tmp_path / "s3", tmp_path / "blob"
    os.makedirs(src / "archive" / "images" / "2023" / "2024")
    for i in range(5):
        (src / "archive" / "images" / "2023" / "2024" / f"{i}.jpg").write_bytes(bytes([i]) * (i * 10))
    assert main(["copy", "--src", str(src), "--dst", str(dst), "--prefix", "archive/images/2023"]) == 0
    assert "ok: 5 objects, 100 bytes" in capsys.readouterr().out
    assert main(["copy", "--src", str(src), "--dst", str(dst), "--prefix", "archive/images/2023",
                 "--resume"]) == 0
    assert sorted(os.listdir(dst / "archive" / "images" / "2023" / "2024")) == [f"{i}.jpg" for i in range(5)]
