"""A Python worker serves the tasks of many steps; it keeps the caches of one step only."""

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa

from millrace.llm import bpe, pii, toxicity
from millrace.llm.common import forget, kept_by_worker


class Thing:
    pass


def test_one_thing_is_kept_at_a_time():
    first = kept_by_worker("first", Thing)
    assert kept_by_worker("first", Thing) is first
    gone = weakref.ref(first)
    del first
    # The old one is dropped before the new one is built.
    assert kept_by_worker("second", lambda: (gc.collect(), gone())[1]) is None


def test_a_matcher_makes_room_for_a_codec():
    gone = weakref.ref(toxicity.matcher(["idiot"]))
    kept_by_worker(("codec", "x"), lambda: bpe.Codec({bytes([b]): b for b in range(256)}, r"\S+"))
    gc.collect()
    assert gone() is None


def test_what_is_kept_can_be_dropped_without_a_successor():
    gone = weakref.ref(kept_by_worker("first", Thing))
    forget()
    gc.collect()
    assert gone() is None


def test_spellings_take_memory_by_slices_not_by_batches():
    texts = [" ".join(f"w{i * k % 997}" for i in range(4000)) for k in range(1, 321)]
    batch = pa.array([*texts, None, ""])
    tracemalloc.start()
    got = toxicity.spelled_forms(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.type == pa.list_(pa.string()) and len(got) == len(batch) and got[-2:].to_pylist() == [[], []]
    assert got[0].as_py() == sorted({w for w in texts[0].split() if len(w) >= 3})
    assert peak < 100 << 20


def _resident() -> int:
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * 4096


def test_memory_of_what_is_dropped_goes_back_to_the_system():
    """Also where something that stays lies between the dropped parts."""

    class Parts:
        def __init__(self):
            self.parts, self.stay = [], []
            for _ in range(4000):
                self.parts.append(np.ones(50_000, np.uint8))
                self.stay.append(np.ones(2_000, np.uint8))

    forget()
    stay = kept_by_worker("parts", Parts).stay
    before = _resident()
    forget()
    assert len(stay) == 4000 and before - _resident() > 120 << 20


def test_steps_without_caches_drop_those_of_the_step_before():
    gone = weakref.ref(kept_by_worker("first", Thing))
    pii.redacted_texts(pa.array(["mail a@b.cc", None, ""]))
    gc.collect()
    assert gone() is None
