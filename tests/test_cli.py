"""The command line runs a catalogue query and shows it on the console."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_cli_query_shows_rows():
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "cinerank", "query", "rate_more_movies", SF_SMALL],
                         cwd="/tmp", env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "|mid|count|" in out.stdout.replace(" ", "")


def test_cli_usage_without_arguments():
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "cinerank"], cwd="/tmp", env=env,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 2 and "python -m cinerank" in out.stdout
