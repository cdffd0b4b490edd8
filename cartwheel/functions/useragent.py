"""Device class and operating system of a user-agent string.

A handful of substring tests, so it runs inside the scan stage: no distinct, join or lookup shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, tried from top to bottom: marker in the lower-case user agent, result.
ROBOT_MARKS = ("bot", "crawler", "spider", "slurp")
DEVICE_MARKS = (
    ("ipad", "Tablet"),
    ("tablet", "Tablet"),
    ("kindle", "Tablet"),
    ("iphone", "Phone"),
    ("ipod", "Phone"),
    ("windows phone", "Phone"),
    ("mobile", "Phone"),
    ("android", "Tablet"),
    ("windows nt", "Desktop"),
    ("macintosh", "Desktop"),
    ("cros", "Desktop"),
    ("linux", "Desktop"),
)
OS_MARKS = (
    ("windows phone", "Windows Phone"),
    ("windows nt", "Windows NT"),
    ("ipad", "iOS"),
    ("iphone", "iOS"),
    ("ipod", "iOS"),
    ("macintosh", "Mac OS"),
    ("android", "Android"),
    ("cros", "Chrome OS"),
    ("linux", "Linux"),
)
UNKNOWN = "Unknown"


def _first_match(agent: Column, marks: tuple[tuple[str, str], ...]) -> Column:
    (mark, result), *rest = marks
    chain = F.when(agent.contains(mark), result)
    for mark, result in rest:
        chain = chain.when(agent.contains(mark), result)
    return chain.otherwise(UNKNOWN)


def is_robot(agent: Column) -> Column:
    low = F.lower(agent)
    hit = F.lit(False)
    for mark in ROBOT_MARKS:
        hit = hit | low.contains(mark)
    return F.coalesce(hit, F.lit(False))


def device_class(agent: Column) -> Column:
    return F.when(is_robot(agent), "Robot").otherwise(_first_match(F.lower(agent), DEVICE_MARKS))


def os_name(agent: Column) -> Column:
    return _first_match(F.lower(agent), OS_MARKS)


def user_agent(agent: Column) -> Column:
    return F.struct(device_class(agent).alias("platform"), os_name(agent).alias("type"))


DEVICE_CLASSES = ("Desktop", "Phone", "Tablet", "Robot", UNKNOWN)
