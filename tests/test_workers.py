"""Functions sent to Python workers must not need the package there."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_run_from_another_folder(tmp_path):
    script = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as contract
        from stallweave.session import build_session
        spark = build_session("elsewhere", master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
        for name in ("document_vectors", "hybrid_topk", "exact_topk_blocks", "ivf_topk_recall", "drift_safe_read"):
            assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
        print("fine")
    """
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(script)], cwd=tmp_path, capture_output=True, text=True, timeout=600,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=False,
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
