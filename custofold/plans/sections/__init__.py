"""Sub-documents of a customer document.

Each function takes the datasets by name (and the value-set table) and returns the document key plus one
column with a single value per row. Copies of a value may occur; gathering removes them.
"""

from custofold.plans.sections.address import address_requests, address_rows, source_address
from custofold.plans.sections.classes import classification, flags
from custofold.plans.sections.contacts import email, phone
from custofold.plans.sections.countries import countries
from custofold.plans.sections.identity import identifiers, national_id, passport
from custofold.plans.sections.individual import individual_base, individual_rows, other_numbers, relation_kinds
from custofold.plans.sections.relations import individual_relations, organisation_relations

__all__ = [
    "address_requests",
    "address_rows",
    "classification",
    "countries",
    "email",
    "flags",
    "identifiers",
    "individual_base",
    "individual_relations",
    "individual_rows",
    "national_id",
    "organisation_relations",
    "other_numbers",
    "passport",
    "phone",
    "relation_kinds",
    "source_address",
]
