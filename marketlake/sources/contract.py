"""The vacancy contract: one declared schema for raw records and the silver table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.casts import try_cast_text

_TEXT, _LONG, _REAL, _FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()

# --- Fixed values: field names and types of a raw vacancy record -------------
# A dict is a STRUCT, a one-element list an ARRAY.
_ID_NAME = {"id": _TEXT, "name": _TEXT}
_METRO = {"station_name": _TEXT, "line_name": _TEXT, "station_id": _TEXT, "line_id": _TEXT,
          "lat": _REAL, "lng": _REAL}
_PICTURE = {"width": _LONG, "height": _LONG, "url": _TEXT}
_PICTURES = {"default": _PICTURE, "xs": _PICTURE}
_MEDIA = {"upload_id": _TEXT, "url": _TEXT}

_RECORD = {
    "id": _TEXT,
    "name": _TEXT,
    "schedule": _ID_NAME,
    "working_time_modes": [_ID_NAME],
    "working_time_intervals": [_ID_NAME],
    "working_days": [_ID_NAME],
    "working_hours": [_ID_NAME],
    "work_schedule_by_days": [_ID_NAME],
    "fly_in_fly_out_duration": [_ID_NAME],
    "is_adv_vacancy": _FLAG,
    "internship": _FLAG,
    "accept_temporary": _FLAG,
    "accept_incomplete_resumes": _FLAG,
    "premium": _FLAG,
    "has_test": _FLAG,
    "show_contacts": _FLAG,
    "response_letter_required": _FLAG,
    "show_logo_in_search": _FLAG,
    "archived": _FLAG,
    "night_shifts": _FLAG,
    "created_at": _TEXT,
    "published_at": _TEXT,
    "url": _TEXT,
    "alternate_url": _TEXT,
    "apply_alternate_url": _TEXT,
    "response_url": _TEXT,
    "adv_response_url": _TEXT,
    "immediate_redirect_url": _TEXT,
    "salary": {"from": _LONG, "to": _LONG, "currency": _TEXT, "gross": _FLAG},
    "salary_range": {"from": _LONG, "to": _LONG, "currency": _TEXT, "gross": _FLAG,
                     "mode": _ID_NAME, "frequency": _ID_NAME},
    "employer": {"id": _TEXT, "name": _TEXT, "url": _TEXT, "alternate_url": _TEXT,
                 "logo_urls": {"original": _TEXT, "90": _TEXT, "240": _TEXT},
                 "vacancies_url": _TEXT, "country_id": _LONG,
                 "accredited_it_employer": _FLAG, "trusted": _FLAG},
    "department": _ID_NAME,
    "type": _ID_NAME,
    "employment": _ID_NAME,
    "employment_form": _ID_NAME,
    "experience": _ID_NAME,
    "area": {"id": _TEXT, "name": _TEXT, "url": _TEXT},
    "address": {"city": _TEXT, "street": _TEXT, "building": _TEXT, "lat": _REAL, "lng": _REAL,
                "description": _TEXT, "raw": _TEXT, "metro": _METRO,
                "metro_stations": [_METRO], "id": _TEXT},
    "work_format": [_ID_NAME],
    "relations": [_TEXT],
    "professional_roles": [_ID_NAME],
    "contacts": {"name": _TEXT, "email": _TEXT,
                 "phones": [{"country": _TEXT, "city": _TEXT, "number": _TEXT,
                             "comment": _TEXT}]},
    "adv_context": _TEXT,
    "sort_point_distance": _REAL,
    "snippet": {"requirement": _TEXT, "responsibility": _TEXT},
    "branding": {"type": _TEXT, "tariff": _TEXT},
    "insider_interview": {"id": _TEXT, "url": _TEXT},
    "video_vacancy": {
        "cover_picture": {"resized_path": _TEXT, "resized_width": _LONG, "resized_height": _LONG},
        "snippet_picture": {"url": _TEXT},
        "video": _MEDIA,
        "snippet_video": _MEDIA,
        "video_url": _TEXT,
        "snippet_video_url": _TEXT,
        "snippet_picture_url": _TEXT,
    },
    "brand_snippet": {
        "logo": _TEXT,
        "logo_xs": _TEXT,
        "logo_scalable": _PICTURES,
        "picture": _TEXT,
        "picture_xs": _TEXT,
        "picture_scalable": _PICTURES,
        "background": {
            "color": _TEXT,
            "gradient": {"angle": _REAL, "color_list": [{"color": _TEXT, "position": _REAL}]},
        },
    },
}

# Columns the publisher marks as deprecated.
DEPRECATED_COLUMNS = [
    "employment",
    "salary",
    "schedule",
    "working_days",
    "working_time_intervals",
    "working_time_modes",
]
# -----------------------------------------------------------------------------


def _declare(spec) -> T.DataType:
    if isinstance(spec, dict):
        return T.StructType([T.StructField(n, _declare(s)) for n, s in spec.items()])
    if isinstance(spec, list):
        return T.ArrayType(_declare(spec[0]))
    return spec


VACANCY = _declare(_RECORD)


def as_text(dtype: T.DataType) -> T.DataType:
    """The same shape with every leaf declared STRING.

    JSON scalars of any kind parse into a STRING leaf, so a number sent as text (or
    the other way round) survives parsing; ``try_cast`` to the contract type then
    nulls only the leaf that really cannot be converted.
    """
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_text(dtype.elementType))
    return T.StringType()


def lost_in_cast(raw: Column, dtype: T.DataType) -> Column | None:
    """True where a leaf holds text that the contract type cannot represent."""
    if isinstance(dtype, T.StructType):
        parts = [lost_in_cast(raw.getField(f.name), f.dataType) for f in dtype]
        parts = [p for p in parts if p is not None]
        if not parts:
            return None
        lost = parts[0]
        for part in parts[1:]:
            lost = lost | part
        return lost
    if isinstance(dtype, T.ArrayType):
        if lost_in_cast(F.lit(None), dtype.elementType) is None:
            return None
        return F.coalesce(
            F.exists(raw, lambda item: lost_in_cast(item, dtype.elementType)), F.lit(False)
        )
    if isinstance(dtype, T.StringType):
        return None
    return raw.isNotNull() & try_cast_text(raw, dtype).isNull()
