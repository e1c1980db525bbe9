import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from cases import ODD_TEXTS

from corpusflow.llm import simhash
from corpusflow.llm.components import components


def slow_print(text):
    words = bytes((text or "").encode()).lower().split()
    if not words:
        return 0
    count = max(1, len(words) - 2)
    hashes = [xxhash.xxh64(b" ".join(words[k : k + 3]), seed=42).intdigest() for k in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def slow_components(prints, radius=3):
    """The smallest place reachable, by trying all pairs."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def near(seed, groups=12, copies=25):
    """Fingerprints in clusters, some just inside the radius and some just outside."""
    rng = np.random.default_rng(seed)
    prints = set()
    for _ in range(groups):
        base = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(copies):
            flips = rng.choice(64, int(rng.integers(0, 6)), replace=False)
            prints.add(base ^ sum(1 << int(b) for b in flips))
    return sorted(prints)


@settings(max_examples=30)
@given(st.text(max_size=200))
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == slow_print(text)


def test_long_text_is_hashed_whole():
    text = " ".join(str(k * k) for k in range(simhash.HASHES_AT_ONCE + 10))
    assert simhash.simhash(text.encode()) == slow_print(text)


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_masks_catch_every_link(radius):
    masks = [np.uint64(m % (1 << 64)) for m in simhash.band_masks(radius)]
    rng = np.random.default_rng(radius)
    for _ in range(300):
        flips = rng.choice(64, radius, replace=False)
        change = np.uint64(sum(1 << int(b) for b in flips))
        assert any(change & mask == 0 for mask in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_lanes(radius):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 128, dtype=np.uint64)
    prints[64:] = prints[:64] ^ np.uint64(0b1011)
    planes = simhash.bit_planes(prints)
    asked, block = np.repeat(prints, 2), np.tile([0, 1], 128)
    row, lanes = simhash.lanes_within(asked, planes, block, radius)
    got = {(int(r), k) for r, w in zip(row, lanes) for k in range(64) if int(w) >> k & 1}
    expected = {
        (r, k)
        for r in range(256)
        for k in range(64)
        if (int(asked[r]) ^ int(prints[block[r] * 64 + k])).bit_count() <= radius
    }
    assert got == expected


@pytest.mark.parametrize("part", [1024, 8])
def test_components_of_links(spark, part):
    """A hot bucket cut into parts gives the same components as one that isn't."""
    prints = near(3)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "bits long")
    found = components(simhash.links(nodes, 3, part)).collect()
    got = {}
    for node, component in found:
        got.setdefault(component, set()).add(node)
    expected = {}
    for place, label in enumerate(slow_components(prints)):
        expected.setdefault(label, set()).add(signed(prints[place]))
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(v) for v in expected.values() if len(v) > 1
    )


def test_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(7, 7), (None, 1)], "u long, v long")
    assert {tuple(r) for r in components(links).collect()} == {(k, 0) for k in range(201)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_documents(odd):
    prints = [slow_print(t) for _, t in ODD_TEXTS]
    label = slow_components(prints)
    least = {}
    for (doc, _), group in zip(ODD_TEXTS, label):
        if doc is not None:
            least[group] = min(doc, least.get(group, doc))
    expected = [(d, p, least.get(g)) for (d, _), p, g in zip(ODD_TEXTS, prints, label)]
    found = simhash.near_duplicates(odd).select("doc_id", simhash.hex_digits(), "component_id")
    got = [(d, int(h, 16), c) for d, h, c in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_no_documents(none):
    assert simhash.near_duplicates(none).count() == 0
