"""Nested forum replies: any depth, stubs, odd listings, and the dataset built from them."""

import datetime as dt
import json

from courtline.plans import datasets as D
from courtline.plans.queries_io import seed_lexicon
from courtline.sources.forum import COMMENT_SCHEMA, TREE_SCHEMA, flatten_trees, read_comment_trees
from courtline.session import scratch_path

URL = "https://www.reddit.com/r/nba/comments/id1/"
STUB = {"kind": "more", "data": {"count": 4, "children": ["x"]}}


def listing(*children):
    return {"kind": "Listing", "data": {"after": None, "children": list(children)}}


def comment(name, *replies, score=1, author="ann", body=None, edited=False):
    return {"kind": "t1", "data": {"id": name, "author": author, "body": body or f"text of {name}", "score": score, "edited": edited,
                                   "author_flair_text": None, "replies": listing(*replies) if replies else ""}}


def plain(tree, parent=None, path=()):
    """The same by recursion."""
    out, place = [], 0
    for c in tree["data"]["children"]:
        if c["kind"] != "t1":
            continue
        d, here = c["data"], (*path, place)
        place += 1
        out.append((d["id"], parent, d["body"], len(here), here))
        if d["replies"]:
            out += plain(d["replies"], d["id"], here)
    return out


def flat(spark, rows):
    return flatten_trees(spark.createDataFrame(rows, TREE_SCHEMA).repartition(2))


def test_trees_of_any_depth(spark):
    chain = comment("d9")
    for i in range(8, 0, -1):
        chain = comment(f"d{i}", comment(f"s{i}", body='quoted "{[ text'), STUB, chain, comment(f"e{i}"))
    tree = listing(STUB, comment("a"), chain, comment("b", comment("b1", comment("b2"))), STUB)
    got = flat(spark, [(URL, json.dumps(tree))])
    assert set(COMMENT_SCHEMA.fieldNames()) <= set(got.columns)
    rows = got.collect()
    assert sorted((r.comment_id, r.parent_id or "", r.body, r.depth, tuple(r.path)) for r in rows) == sorted((a, b or "", *c) for a, b, *c in plain(tree))
    assert max(r.depth for r in rows) == 9 and not any(r.is_stub for r in rows)


def test_odd_listings_hold_no_comments(spark):
    no_data, only_stub = listing({"kind": "t1"}, comment("x")), listing(STUB)
    rows = [(URL, None), (URL, ""), (URL, "not json"), (URL, json.dumps(listing())), (URL, json.dumps(only_stub)), (URL, "{}"),
            (None, json.dumps(no_data)), ("u", json.dumps(no_data)), ("u", json.dumps(no_data))]
    assert sorted((r.post_url or "", r.comment_id, tuple(r.path)) for r in flat(spark, rows).collect()) == [("", "x", (0,)), ("u", "x", (0,)), ("u", "x", (0,))]
    assert flat(spark, []).count() == 0


def test_landed_trees_make_the_dataset(spark):
    """A deleted author goes; of equal comments the best scored stays, of equal scores the last level by level."""
    tree = listing(comment("a", comment("a1", score=3, body="great game", edited=1700000000.0), comment("a2", author=None, body="gone")),
                   comment("b", comment("b1", comment("b2", score=3, body="great game")), score=9, author="bob", body="fine"))
    path = scratch_path(spark, "t-trees")
    spark.createDataFrame([(json.dumps({"post_url": URL, "comments": tree}),), (json.dumps({"post_url": "https://elsewhere", "comments": tree}),)],
                          "value string").write.text(path)
    posts = spark.createDataFrame([(URL,)], "reddit_url string")
    run = D.RunParams(dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6))
    got = D.reddit_comments(flatten_trees(read_comment_trees(spark, path)), posts, seed_lexicon(spark), run).collect()
    assert sorted((r.author, r.comment, r.score, r.edited) for r in got) == [("ann", "great game", 3, 0), ("ann", "text of a", 1, 0), ("ann", "text of b1", 1, 0), ("bob", "fine", 9, 0)]
