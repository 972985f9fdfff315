"""The job runner's command line, end to end in its own process."""

from __future__ import annotations

import os
import subprocess
import sys

import pyarrow.parquet as pq

from tests.fixtures import write_landing

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_runs_every_job(tmp_path):
    landing = write_landing(str(tmp_path / "landing"))
    wh = str(tmp_path / "wh")
    cmd = [sys.executable, "-m", "emporia.plans.jobs", "all", "--landing", landing,
           "--warehouse-root", wh, "--shuffle-partitions", "3", "--infer-undeclared", "customers",
           "--read-option", "orders.encoding=UTF-8"]
    out = subprocess.run(cmd, cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    written = [line for line in out.stdout.splitlines() if " -> " in line]
    assert len(written) == 21
    daily = pq.read_table(os.path.join(wh, "gold", "gold_daily_sales"))
    assert daily.num_rows == 5  # as in tests/test_gold.py::test_daily_sales_values
    assert daily.column_names == ["order_date", "customer_state", "total_orders", "total_revenue",
                                  "avg_order_value"]


def test_cli_rejects_an_unknown_dataset_option():
    out = subprocess.run([sys.executable, "-m", "emporia.plans.jobs", "gold", "--read-option", "nothing.sep=;"],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode != 0 and "reader option" in out.stderr


def test_cli_rejects_an_unknown_job(tmp_path):
    out = subprocess.run([sys.executable, "-m", "emporia.plans.jobs", "gold-nothing"],
                         cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode != 0 and "unknown job" in out.stderr
