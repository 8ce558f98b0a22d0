"""The tokeniser's worker: what it hands to the libraries, and at what cost."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from goldrec.llm.sentencepiece_codec import LEARN, Codec, model_bytes

ODD = ["▁a", "b", "▁▁▁", "日本", "▁é", "<0x41>", "²", "\n", "\x00", "▁" + "x" * 5000, "🎉🎉", "."]


def test_new_segments_are_one_input():
    codec, results = Codec(model_bytes()), []

    class Backend:
        def __getattr__(self, name):
            def call(*args, **named):
                results.extend(got := getattr(backend, name)(*args, **named))
                return got

            return call

    backend, codec.backend = codec.backend, Backend()
    text = " ".join(f"w{'abcdefghij'[i % 10]}{chr(97 + i // 10 % 26)}{chr(97 + i // 260)}" for i in range(2 * LEARN))
    (row,), (same,), (back,) = codec.encode_rows([text])
    assert same and back and len(results) == -(-len(codec.known) // LEARN)
    assert row == b"".join(codec.known[s] for s in codec.segments.findall("▁" + text.replace(" ", "▁")))


def test_segments_end_where_they_would_alone():
    codec = Codec(model_bytes())
    alone = [b"".join(codec._ids_of([s])) for s in ODD]
    assert alone == list(codec._ids_of(ODD)) and all(alone)
    codec.takes[:] = 0  # as if all pieces were unknown: each segment by itself
    assert list(codec._ids_of(ODD)) == alone


def test_encoding_starts_no_threads():
    """A task has one core; threads of the libraries would take memory of their own in every worker."""
    code = """
import os
from goldrec.llm.sentencepiece_codec import Codec, model_bytes
codec = Codec(model_bytes())
before = len(os.listdir("/proc/self/task"))
assert codec.encode_rows(["some plain words, then others", None, ""])[1:] == ([True] * 3, [True] * 3)
assert len(os.listdir("/proc/self/task")) == before
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[2], timeout=120)
