"""Python tasks must find the package wherever the session was started."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

pytest.importorskip("google.protobuf")

REPO = Path(__file__).resolve().parent.parent
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import registry
from wayside.session import local_session
queries, _ = registry.load()
print("decoded", queries["src_07_gtfs_rt_decode"](local_session(2), "/root/testdata/sf0.001").count())
"""


def test_workers_import_the_package_from_any_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(REPO)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "decoded 2" in done.stdout, done.stderr[-2000:]
