"""Column expressions for message / post records, media paths and URL tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default media root and file-name layouts.
DATA_DIR = "data/telegram/oct_nov_24"
IMAGE_SUFFIXES = ("jpg", "png", "jpeg")
GALLERY_MARK = "gallery"
DELETED_AUTHOR = "Deleted"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def message_type(text="text", media="media") -> Column:
    """Service / text / image / audio / video / web_page / other.

    A document whose mime type is neither audio nor video yields NULL, as
    the reference's nested ``if`` falls through without a return.
    """
    t, m = _c(text), _c(media)
    empty = F.coalesce(t, F.lit("")) == ""
    kind = m.getField("kind")
    mime = m.getField("document").getField("mime_type")
    return (F.when(m.isNull() & empty, F.lit("service"))
            .when(m.isNull(), F.lit("text"))
            .when(kind == "photo", F.lit("image"))
            .when((kind == "document") & mime.contains("audio"), F.lit("audio"))
            .when((kind == "document") & mime.contains("video"), F.lit("video"))
            .when(kind == "document", F.lit(None).cast("string"))
            .when(kind == "webpage", F.lit("web_page"))
            .otherwise(F.lit("other")))


def media_keys(msg_type="msg_type", media="media") -> Column:
    """struct(access_hash, media_id) as strings; photo for images,
    document for audio, NULL otherwise."""
    t, m = _c(msg_type), _c(media)

    def pick(field):
        return (F.when(t == "image", m.getField("photo").getField(field))
                .when(t == "audio", m.getField("document").getField(field)).cast("string"))
    return F.struct(pick("access_hash").alias("access_hash"), pick("id").alias("media_id"))


def py_str(col) -> Column:
    """``str(x)`` compatibility: NULL renders as ``'None'``."""
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def custom_id(channel="channel_name", message="message_id") -> Column:
    """``channel_message`` key."""
    return F.concat(_c(channel), F.lit("_"), _c(message).cast("string"))


def media_path(msg_type="msg_type", channel="channel_name", media_id="media_id",
               data_dir: str = DATA_DIR, audio_ext: str = "png") -> Column:
    """F8: ``dir/channel/images/id.jpg`` or ``dir/channel/audio/id.<audio_ext>``
    (the reference writes ``.png`` for audio); NULL for other types."""
    t = _c(msg_type)
    img = F.concat(F.lit(data_dir + "/"), _c(channel), F.lit("/images/"), _c(media_id), F.lit(".jpg"))
    aud = F.concat(F.lit(data_dir + "/"), _c(channel), F.lit("/audio/"), _c(media_id), F.lit("." + audio_ext))
    return F.when(t == "image", img).when(t == "audio", aud)


def is_image_url(url="url") -> Column:
    """Case-sensitive suffix test (no dot required)."""
    u = _c(url)
    out = F.lit(False)
    for s in IMAGE_SUFFIXES:
        out = out | u.endswith(s)
    return F.coalesce(out, F.lit(False))


def is_gallery_url(url="url") -> Column:
    """Substring test."""
    return F.coalesce(_c(url).contains(GALLERY_MARK), F.lit(False))


def epoch_to_ntz(col) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC, independent of session zone."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), _c(col).cast("decimal(18,6)"))


def gallery_file(subreddit, post_id, idx) -> Column:
    """``sub_post_gallery_idx.png``."""
    return F.format_string("%s_%s_gallery_%d.png", _c(subreddit), _c(post_id), _c(idx))


def image_file(subreddit, post_id) -> Column:
    """``sub_post.jpg``."""
    return F.format_string("%s_%s.jpg", _c(subreddit), _c(post_id))
