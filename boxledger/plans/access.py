"""Row and column policies as explicit functions of the user or role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions import mask_default, mask_email, mask_partial, unmask

__all__ = ["row_filter_anonymous", "row_filter_venue", "row_filter_all", "row_filter_none", "permit_columns",
           "object_hide", "mask_contacts", "Role", "ROLES", "apply_role"]

# Contact columns and the columns other readers may see.
CONTACT_COLUMNS = ("email", "phone", "address_line1")
ALLOWED_COLUMNS = {
    "constituent": ("constituent_id", "first_name", "last_name", "city", "state", "postal_code", "country",
                    "constituent_type", "email_opt_in", "created_at", "updated_at"),
    "email_clicks": ("click_id", "email_campaign_id", "clicked_at", "link_url"),
    "patron": ("patron_id", "first_name", "last_name", "city", "state", "postal_code", "country", "patron_type",
               "email_opt_in", "first_seen_date", "source_systems"),
}


def row_filter_anonymous(gifts: DataFrame, listed: DataFrame, user: str) -> DataFrame:
    """Anonymous gifts are visible only to users on the list.

    Membership is a scalar subquery over the (filtered) list; the gifts are neither joined nor shuffled.
    """
    is_listed = listed.where(F.col("user_principal_name") == user).agg(F.count(F.lit(1)) > 0).scalar()
    return gifts.where(~F.col("is_anonymous") | is_listed)


def row_filter_venue(df: DataFrame, user_venue: DataFrame, user: str) -> DataFrame:
    """Only venues mapped to the user."""
    mine = user_venue.where(F.col("user_principal_name") == user).select("venue_id")
    return df.join(mine, "venue_id", "left_semi")


def row_filter_none(df: DataFrame) -> DataFrame:
    """No filter: the role sees every row."""
    return df


def row_filter_all(df: DataFrame) -> DataFrame:
    """Everything is filtered away: the role sees no row."""
    return df.where(F.lit(False))


def permit_columns(df: DataFrame, table: str, allowed: Mapping[str, Sequence[str]] = ALLOWED_COLUMNS) -> DataFrame:
    """Only allow-listed columns, in list order; a table without a list shows everything."""
    if table not in allowed:
        return df
    return df.select(*[c for c in allowed[table] if c in df.columns])


def object_hide(df: DataFrame, columns: Sequence[str] = CONTACT_COLUMNS) -> DataFrame:
    """Drop columns a role must not know of."""
    return df.drop(*columns)


def mask_contacts(patrons: DataFrame, role: str) -> DataFrame:
    """Contact columns masked, unless the role sees clear text."""
    if unmask(role):
        return patrons
    masks = {"email": mask_email("email"), "phone": mask_partial("phone"), "address_line1": mask_default("address_line1")}
    return patrons.withColumns({c: m for c, m in masks.items() if c in patrons.columns})


@dataclass(frozen=True)
class Role:
    """What a role sees: whether gifts are visible, hidden columns, venue mapping, anonymous gifts."""

    name: str
    sees_gifts: bool = True
    hidden: tuple[str, ...] = ()
    by_venue: bool = False
    anonymous_gifts: bool = True
    tables: tuple[str, ...] = field(default=())


# The roles of the audience model.
ROLES = {
    "Development": Role("Development"),
    "Audience": Role("Audience", sees_gifts=False, hidden=CONTACT_COLUMNS),
    "Venue Manager": Role("Venue Manager", hidden=CONTACT_COLUMNS, by_venue=True, anonymous_gifts=False),
}


def apply_role(table: str, df: DataFrame, role: Role, user: str, user_venue: DataFrame | None = None) -> DataFrame:
    """A table as the role sees it."""
    if table == "gifts":
        if not role.sees_gifts:
            return row_filter_all(df)
        return df if role.anonymous_gifts else df.where(~F.col("is_anonymous"))
    if table == "performance" and role.by_venue:
        return row_filter_venue(df, user_venue, user)
    if table == "patron" and role.hidden:
        return object_hide(df, role.hidden)
    return df
