import subprocess
import sys
from pathlib import Path


def test_files_of_the_same_name_are_collected():
    files = [str(p) for p in sorted(Path(__file__).parent.rglob("test_queries.py"))]
    options = ["--collect-only", "-q", "-p", "no:cacheprovider"]
    done = subprocess.run([sys.executable, "-m", "pytest", *files, *options], capture_output=True)
    assert len(files) > 1 and done.returncode == 0, done.stdout.decode()
