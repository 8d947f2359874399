"""Declared shapes of the entity records and the flat tables."""

from __future__ import annotations

from enum import IntEnum, StrEnum


class Table(StrEnum):
    LABELS = "labels"
    DESCRIPTIONS = "descriptions"
    ALIASES = "aliases"
    LINKS = "links"
    CLAIMS = "claims"


class Step(IntEnum):
    """States of a source file, in order."""

    INIT = 0
    PULL = 1
    PROCESS = 2
    PARTITION = 3
    PUSH = 4
    POST_CHECK = 5
    COMPLETE = 6


#: The column of each flat table that its files are split by.
KEYS = {table: "site" if table is Table.LINKS else "language" for table in Table}

#: Where the nested column of each table comes from in an entity record.
NESTED = {Table.LABELS: "labels", Table.DESCRIPTIONS: "descriptions", Table.ALIASES: "aliases", Table.LINKS: "sitelinks", Table.CLAIMS: "claims"}

TERM = "struct<language:string,value:string>"
TERMS = f"map<string,{TERM}>"
TERM_LISTS = f"map<string,array<{TERM}>>"
SITES = "map<string,struct<site:string,title:string>>"

DATAVALUE = (
    "struct<id:string,labels:map<string,string>,datavalue__string:string,"
    "precision:struct<precision__integer:bigint,precision__number:double>,text:string,language:string,amount:string,"
    "unit:string,`unit-labels`:map<string,string>,upperBound:string,lowerBound:string,time:string,timezone:bigint,"
    "before:bigint,after:bigint,calendarmodel:string,latitude:struct<latitude__number:double,latitude__integer:bigint>,"
    "longitude:struct<longitude__number:double,longitude__integer:bigint>,altitude:string,globe:string>"
)


def snak(datavalue: str) -> str:
    return f"struct<property:string,datavalue:{datavalue},datatype:string,`property-labels`:map<string,string>>"


def claims(datavalue: str) -> str:
    """The claims column, with the union-typed datavalue either as it is parsed (variant) or promoted."""
    snaks = f"map<string,array<{snak(datavalue)}>>"
    return f"map<string,array<struct<mainsnak:{snak(datavalue)},rank:string,references:array<{snaks}>,qualifiers:{snaks}>>>"


PARSED_CLAIMS = claims("variant")
CLAIMS = claims(DATAVALUE)

ENTITY = "id string, labels string, descriptions string, aliases string, sitelinks string, claims string"

ITEM_TYPES = ("wikibase-item", "wikibase-property")
QUANTITY_TYPE = "quantity"
TEXT_TYPE = "monolingualtext"
SCALAR_TYPES = tuple(
    "commonsMedia entity-schema external-id geo-shape globe-coordinate math musical-notation string tabular-data time url "
    "wikibase-form wikibase-lexeme wikibase-sense".split()
)
KNOWN_TYPES = (*ITEM_TYPES, QUANTITY_TYPE, TEXT_TYPE, *SCALAR_TYPES)
