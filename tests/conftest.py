from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusml.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="corpusml-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="corpusml-test-")


BYTES0 = "00401000 56 8D 44 24 08 50 8B F1 ?? 2A\n00401010 E8 1C 1B 00 00"
ASM0 = ".text:00401000 56 8D 44 24  lea eax, [esp+8]\n.text:0040100A mov eax, 1\n.rsrc:00500000 push ebp ; call"
VOCAB0 = ["lea", "push", "call", "mov"]


def write(path: str, text: str, newline: str | None = "") -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline=newline) as f:
        f.write(text)
    return path


def make_dataset(root: str, docs: dict[str, tuple[str, str]]) -> str:
    """``{base}/bytes/{hash}.bytes`` and ``{base}/asm/{hash}.asm`` per hash."""
    for h, (b, a) in docs.items():
        write(f"{root}/bytes/{h}.bytes", b)
        write(f"{root}/asm/{h}.asm", a)
    return root
