"""Hand-written posts, one or more per case the operators have to get right."""

EASTERN = "Eastern Time (US & Canada)"
ATLANTIC = "Atlantic Time (Canada)"
INDIANA = "Indiana (East)"


def tag_list(tags):
    return {"hashtags": None if tags is None else [{"text": tag} for tag in tags]}


def post(
    id,
    author,
    text="hello",
    tags=(),
    zone=None,
    count=0,
    reply_to=None,
    source=None,
    source_tags=(),
    source_reply_to=None,
    created="Thu Sep 13 03:30:22 +0000 2012",
    **more,
):
    original = source and {
        "user": {"name": source},
        "in_reply_to_screen_name": source_reply_to,
        "entities": tag_list(source_tags),
    }
    return {
        "id": id,
        "text": text,
        "created_at": created,
        "retweet_count": count,
        "in_reply_to_screen_name": reply_to,
        "user": {"name": author, "time_zone": zone},
        "entities": tag_list(tags),
        "retweeted_status": original or None,
        **more,
    }


POSTS = [
    # An exact copy, and the same id with another counter.
    post(1, "ann", "Good good bad day", ["Obama"], EASTERN, 3, source="hub",
         source_tags=["OBAMA2012"], source_reply_to="zed"),
    post(1, "ann", "Good good bad day", ["Obama"], EASTERN, 3, source="hub",
         source_tags=["OBAMA2012"], source_reply_to="zed"),
    post(1, "ann", "Good good bad day", ["Obama"], EASTERN, 4, source="hub",
         source_tags=["OBAMA2012"]),
    # A tag that holds the needle; both topics; the second needle; the other topic.
    post(2, "bob", "bad BAD http://t.co/A1, worse", ["nobama"], EASTERN, 5, reply_to="ann"),
    post(3, "cat", "good", ["Obama", "Romney"], EASTERN),
    post(4, "dan", " a good  day", ["obama2012"], ATLANTIC, 2, source="hub",
         source_tags=["romney"]),
    post(5, "eve", "Mitt's bad day", ["RomneyRyan"], EASTERN, 7, source="ann",
         source_tags=["romney", "tcot"]),
    # A reshare that is a reply too; a self-reshare.
    post(6, "fay", "both", ["tcot"], INDIANA, 1, reply_to="eve", source="bob"),
    post(7, "hub", "me again", [], EASTERN, 1, source="hub"),
    # No text, empty text, blanks.
    post(8, "gus", None, [], EASTERN, created=None),
    post(9, "gus", "", None, EASTERN, created="not a time"),
    post(10, "gus", "   ", None, None, created="Fri Sep 14 07:25:11 +0200 2012"),
    # No entities at all; a tag without text; a place.
    {"id": 11, "text": "bare", "created_at": "Xyz Sep 14 07:25:11 +0000 2012"},
    post(12, "ian", "place", [None, "romney"], EASTERN, source="hub",
         geo={"type": "Point", "coordinates": [1.5, 2.5]},
         place={"country": "Italia", "country_code": "IT"}),
]
