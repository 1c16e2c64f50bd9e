"""Hall calendar views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import conditional_sum
from ..operators.aggregate import top_n
from ..operators.joins import inner_star

__all__ = ["room_utilisation", "top_rental_clients", "upcoming_calendar", "HOURS_PER_DAY"]

HOURS_PER_DAY = 14


def room_utilisation(bookings: DataFrame, events: DataFrame, rooms: DataFrame, calendar: DataFrame) -> DataFrame:
    """Hours by kind of use and share of the bookable hours, per room and month.

    Cancelled events and bookings without positive length are out; overlapping bookings add up, so a share has no upper bound.
    """
    star = inner_star(bookings.where(F.col("hours_booked") > 0), [
        (events.where(F.col("status") != "Cancelled").select("event_key", "event_type"), "event_key"),
        (rooms.select("room_key", "room_name", "room_type"), "room_key"),
        (calendar.select(F.col("date_key").alias("booking_date_key"), "date", "fiscal_year", "calendar_year",
                         "month_num", "month_name"), "booking_date_key")])

    def hours(kind: str):
        return conditional_sum("hours_booked", F.col("event_type") == kind)

    grouped = star.groupBy("room_name", "room_type", "fiscal_year", "calendar_year", "month_num", "month_name").agg(
        hours("Concert").alias("concert_hours"), hours("Rental").alias("rental_hours"),
        hours("Rehearsal").alias("rehearsal_hours"), F.sum("hours_booked").alias("hours_booked"),
        (F.day(F.last_day(F.min("date"))) * F.lit(HOURS_PER_DAY)).alias("hours_available"),
        conditional_sum("rental_fee", F.col("event_type") == "Rental").alias("rental_revenue"))
    return grouped.withColumn("utilisation", (F.col("hours_booked") / F.col("hours_available")).cast("decimal(17,3)"))


def top_rental_clients(bookings: DataFrame, events: DataFrame, n: int) -> DataFrame:
    """Rental fees by client; ties at the boundary are all shown."""
    rentals = events.where((F.col("event_type") == "Rental") & (F.col("status") != "Cancelled"))
    fees = bookings.join(rentals.select("event_key", "client_name"), "event_key").groupBy("client_name").agg(
        F.sum("rental_fee").alias("rental_fees"), F.count(F.lit(1)).alias("bookings"))
    return top_n(fees, n, "rental_fees").orderBy(F.col("rental_fees").desc_nulls_last(), "client_name")


def upcoming_calendar(bookings: DataFrame, events: DataFrame, rooms: DataFrame, as_of) -> DataFrame:
    """Confirmed and tentative bookings from the given day on, by time and room."""
    future = bookings.where(F.to_date("start_datetime") >= F.lit(as_of).cast("date"))
    planned = events.where(F.col("status").isin("Confirmed", "Tentative"))
    joined = inner_star(future, [(planned.select("event_key", "event_name", "event_type", "status"), "event_key"),
                                 (rooms.select("room_key", "room_name"), "room_key")])
    return joined.select("booking_id", "room_name", "event_name", "event_type", "status", "start_datetime",
                         "end_datetime").orderBy("start_datetime", "room_name", "booking_id")
