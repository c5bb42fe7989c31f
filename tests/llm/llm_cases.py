"""Texts and tables that several test modules share."""

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside or return themselves.
CLASH = ["fp", "size", "h", "base", "cands", "added", "score", "shard", "component_id", "ids", "_t", "_id", "_k0", "_o0", "value", "m", "copies", "taken", "node", "root", "variant", "target", "src", "id", "kind", "a", "b", "key", "_p", "_g", "_n", "__stay", "__text", "__n", "__r", "n", "_h", "_c0", "__w", "text_hash", "__base", "__cands"]


def prose(seed: int, words: int, vocabulary: int = 5000) -> str:
    import random

    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def edge_rows() -> list[tuple]:
    long = prose(1, 60000)
    same = prose(2, 80)
    return [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", None, None, 7),
        (4, long, "en", "b", len(long)),
        (5, same, "en", "b", len(same)),
        (6, same, "en", None, len(same)),
        (7, same, "de", "b", None),
        (7, same, "de", "b", None),
        (7, same + " more", "de", "b", None),
        (None, "one text without an id +49 89 1234567 a@b.co", "en", "c", 20),
        (None, None, None, None, None),
        (8, "x" * 30000, "en", "c", 30000),
        (9, "1" * 20000 + " é😀   ﷽ '" * 3, "fr", "c", 20000),
        (10, "Ab", "fr", "", 2),
        (11, "+-.@,", "fr", "", 5),
        (12, "." * 5000 + "a.b@" * 2000, "es", "d", 13000),
        (-5, "negative id", "es", "d", 11),
        (1 << 60, "large id", "es", "d", 8),
    ]
