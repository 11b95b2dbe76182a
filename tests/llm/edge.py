"""A small table with every odd case, and plain counterparts of what the operators compute."""

import re
import zlib

CLASHING = ["size", "fp", "length", "piece", "slice", "score", "block", "same", "id", "row", "shard", "component_id", "held_out", "key", "h", "n", "term"]

LONG = " ".join(f"word{i % 977} other{i}" for i in range(20_000))


def rows():
    plain = [f"text number {i} holds some words of its own like w{i * 7919} and v{i * 104729}" for i in range(30)]
    texts = [None, "", " \t\n", "one", "one", "two words", LONG, plain[0], plain[0], *plain, "çà ÉÀ ß x", "<|endoftext|> and more"]
    out = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "z")[i % 4]) for i, t in enumerate(texts)]
    return out + [(None, "no id here at all", "en", "a"), (None, None, None, None), out[5], out[5]]


def documents(spark, some=None):
    """The table with extra columns whose names the operators might use themselves."""
    data = [(*r, *([7] * len(CLASHING))) for r in (rows() if some is None else some)]
    extra = ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(data, f"doc_id bigint, text string, lang string, source string, {extra}")


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def bucket(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def groups(pairs, members):
    """Smallest member that each one reaches over the pairs."""
    root = {m: m for m in members}
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(root[a], root[b])
            for x in (a, b):
                if root[x] != low:
                    root[x], moved = low, True
    return root
