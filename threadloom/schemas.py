"""Schemas of the input archives and of the tables made from them."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def _list(**fields) -> T.ArrayType:
    return T.ArrayType(_struct(**fields))


_URL = _list(url=S, expanded_url=S, display_url=S, indices=T.ArrayType(S))
_ENTITIES = _struct(urls=_URL, hashtags=_list(text=S, indices=T.ArrayType(S)), user_mentions=_list(screen_name=S, name=S, id=S, id_str=S, indices=T.ArrayType(S)))
_SIZE = _struct(w=S, h=S, resize=S)
POST = _struct(
    id_str=S, id=S, full_text=S, text=S, created_at=S, in_reply_to_status_id_str=S, in_reply_to_user_id_str=S, in_reply_to_screen_name=S,
    favorite_count=S, retweet_count=S, favorited=B, retweeted=B, truncated=B, possibly_sensitive=B, is_quote_status=B, quoted_status_id_str=S, lang=S, source=S,
    community_id_str=S, entities=_ENTITIES, extended_entities=_struct(media=_list(type=S, media_url=S, sizes=T.MapType(S, _SIZE))),
)
#: hashtags are strings or objects: kept as text, told apart when they are read
NOTE = _struct(
    noteTweetId=S, createdAt=S, updatedAt=S,
    core=_struct(text=S, urls=_list(shortUrl=S, expandedUrl=S, expanded_url=S, displayUrl=S, fromIndex=S, toIndex=S), mentions=_list(screenName=S), hashtags=T.ArrayType(S)),
)
LIKE = _struct(tweetId=S, fullText=S, expandedUrl=S)
_PROFILE_BODY = dict(
    id=S, userName=S, screen_name=S, displayName=S, name=S, handle=S, userInformations=_struct(id=S, userName=S, displayName=S),
    description=_struct(bio=S, website=S, location=S), avatarMediaUrl=S, headerMediaUrl=S,
)
PROFILE = _struct(**_PROFILE_BODY, profile=_struct(**_PROFILE_BODY))
ARCHIVE = T.StructType(
    [
        T.StructField("account", _list(account=_struct(username=S, accountId=S, createdAt=S, createdVia=S, accountDisplayName=S))),
        T.StructField("profile", T.ArrayType(PROFILE)),
        T.StructField("tweets", _list(tweet=POST)),
        T.StructField("community-tweet", _list(tweet=POST)),
        T.StructField("note-tweet", _list(noteTweet=NOTE)),
        T.StructField("like", _list(like=LIKE)),
        T.StructField("follower", _list(follower=_struct(accountId=S, userLink=S))),
        T.StructField("following", _list(following=_struct(accountId=S, userLink=S))),
        T.StructField("_metadata", T.MapType(S, S)),
    ]
)

_TEXTS = T.ArrayType(S)
#: One row for each mention of a post in an archive.
SOURCE_TWEETS = _struct(
    id=S, user_id=S, user_screen_name=S, user_name=S, in_reply_to_status_id=S, in_reply_to_user_id=S, in_reply_to_screen_name=S, retweet_count=I,
    favorite_count=I, full_text=S, lang=S, source=S, created_at=TS, favorited=B, retweeted=B, possibly_sensitive=B, urls=_TEXTS, media=_TEXTS,
    hashtags=_TEXTS, user_mentions=_TEXTS, tweet_type=S, archive_file=S, is_reply=B,
)
URLS = _struct(
    username=S, tweet_id=S, tweet_created_at=TS, url=S, domain=S, raw_domain=S, protocol=S, path=S, query=S, fragment=S, title=S, description=S,
    content_type=S, status_code=I, error=S,
)
TREES = _struct(root_id=L, descendant_ids=T.ArrayType(L), quoted_ids=T.ArrayType(L), quoting_ids=T.ArrayType(L))
IDENTITY = _struct(user_id=S, ts=TS, username=S, display_name=S, avatar_url=S)
