"""Texts and plain versions shared by the tests."""

import re
import unicodedata
from collections import Counter

EN = (
    "The harbour of the old town lies behind a long wall of grey stone, and the boats that have come in with the tide rest there until the evening. "
    "People walk to the market to buy bread, fish and fruit, and children play with a ball near the gate. When the wind turns, the sails are dried on the quay, "
    "and the fishermen mend their nets while they talk of the weather and of the prices of the day."
)
VI = (
    "Thành phố nằm bên bờ sông và có nhiều khu chợ cũ. Những người bán hàng mở cửa từ sáng sớm để đón khách từ các vùng quê. "
    "Trong các con phố nhỏ, trẻ em chơi đùa và người già ngồi uống trà. Một số ngôi nhà được xây từ thế kỷ trước, với mái ngói đỏ và sân rộng. "
    "Khi mùa mưa đến, dòng sông dâng cao và mọi người chuẩn bị thuyền để đi lại giữa các khu phố của thành phố."
)
words = re.compile(r"\w+").findall


def lines(text):
    return [x.strip() for x in text.splitlines() if x.strip()]


def normalize(text):
    text = unicodedata.normalize("NFC", text)
    text = re.sub("[​‌‍﻿­]", "", text)
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def greedy(bands):
    """bands: [(seq, keys or None)] in order. Which rows share a key with an earlier row that stayed."""
    kept, out = set(), {}
    for seq, keys in bands:
        out[seq] = bool(keys and kept & set(keys))
        if keys and not out[seq]:
            kept |= set(keys)
    return out


def classes(bands):
    """The least seq reachable over shared keys."""
    at = {s: s for s, _ in bands}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    first = {}
    for s, keys in bands:
        for k in keys or ():
            a, b = root(first.setdefault(k, s)), root(s)
            at[max(a, b)] = min(a, b)
    return {s: root(s) for s in at}


def repeated(parts):
    c = Counter(parts)
    return len(parts), len(parts) - len(c), sum(map(len, parts)), sum(len(x) * (n - 1) for x, n in c.items())
