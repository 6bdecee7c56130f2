"""Account table as batch merges: sign-ups, profile changes, look-ups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.text import trim_space
from tagreef.operators.grouping import first_per_key
from tagreef.operators.numbering import with_index
from tagreef.operators.sizes import broadcast_if_small
from tagreef.schema import ACCOUNTS
from tagreef.shared import saved

# Field limits and the answers a sign-up gets.
NAME_LENGTH = 30
PASSWORD_LENGTH = 30
EMAIL_LENGTH = 50
REFUSED = "User/Pass required"
TAKEN = "Username taken"
DONE = "Signup successful"


def _blank(text: Column) -> Column:
    return F.coalesce(trim_space(text), F.lit("")) == ""


def is_valid_account() -> Column:
    """Name and password given and not too long; an email, if given, not too long."""
    name = ~_blank(F.col("username")) & (F.length("username") <= NAME_LENGTH)
    password = F.coalesce(F.col("password_length").between(1, PASSWORD_LENGTH), F.lit(False))
    email = _blank(F.col("email")) | (F.length("email") <= EMAIL_LENGTH)
    return name & password & email


def check_accounts(signups: DataFrame) -> DataFrame:
    """Sign-ups with ``status``: NULL when they pass, else why they are refused."""
    return signups.withColumn("status", F.when(~is_valid_account(), F.lit(REFUSED)))


def lookup_accounts(accounts: DataFrame, names: str | DataFrame) -> DataFrame:
    """The account of one name, or those of a table of names (``username``)."""
    if isinstance(names, str):
        return accounts.filter(F.col("username") == names)
    return accounts.join(names.select("username").distinct(), "username", "left_semi").select(
        *accounts.columns
    )


def _known_names(accounts: DataFrame, names: DataFrame) -> DataFrame:
    """Those of distinct names that have an account; the names go to the accounts."""
    return accounts.select("username").join(broadcast_if_small(names), "username", "left_semi").distinct()


def apply_signups(accounts: DataFrame, signups: DataFrame, last_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The account table after the sign-ups, and ``(seq, username, status)`` of each.

    Names are lower-cased. The first valid sign-up of a free name, by ``seq``
    (unique), gets it; ids go on from ``last_id``, by default the accounts' greatest.
    Winners go back to the sign-ups by ``seq``, so a name that a third of them ask
    for makes no hot task. Accounts are not shuffled as long as the names asked for
    can be broadcast.
    """
    checked = check_accounts(signups.withColumn("username", F.lower("username")))
    valid = checked.filter(F.col("status").isNull()).drop("status")
    first = saved(first_per_key(valid, ["username"], ["seq"]))
    taken = saved(_known_names(accounts, first.select("username")))
    winners = saved(first.join(broadcast_if_small(taken), "username", "left_anti"))
    if last_id is None:
        last_id = accounts.agg(F.max("id")).first()[0] or 0
    added = with_index(winners, ["seq"], "_nth").select(
        (F.col("_nth") + last_id + 1).cast("int").alias("id"), *ACCOUNTS.names[1:]
    )
    won = winners.select("seq", F.lit(DONE).alias("_won"))
    outcomes = checked.join(won, "seq", "left").select(
        "seq", "username", F.coalesce("status", "_won", F.lit(TAKEN)).alias("status")
    )
    return accounts.select(*ACCOUNTS.names).unionByName(added), outcomes


def apply_profile_patches(accounts: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The account table after the changes, and the changes of unknown names.

    ``patches`` is ``(seq, username, password_hash, email)``. An empty field (or
    NULL) keeps the old value; of several changes of a field the last one counts.
    Changes are reduced to one row per name before they meet the accounts, which are
    not shuffled as long as these rows can be broadcast.
    """
    fields = ("password_hash", "email")
    given = {name: F.when(F.col(name) != "", F.col("seq")) for name in fields}
    last = saved(
        patches.groupBy("username").agg(*[F.max_by(name, given[name]).alias(f"_{name}") for name in fields])
    )
    patched = accounts.join(broadcast_if_small(last), "username", "left").select(
        "id", "username", *[F.coalesce(f"_{name}", name).alias(name) for name in fields]
    )
    # Names meet accounts once each; the unknown ones, usually few, then find their changes.
    names = last.select("username").dropna()
    strange = names.join(_known_names(accounts, names), "username", "left_anti")
    nameless = F.col("username").isNull()
    unknown = patches.join(broadcast_if_small(saved(strange)), "username", "left_semi")
    unknown = unknown.unionByName(patches.filter(nameless))
    return patched, unknown.select(*patches.columns)
