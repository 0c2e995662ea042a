"""Country aliases."""

from __future__ import annotations

# Alias (lower case) -> canonical name.
COUNTRY_ALIASES = {
    "plurinational state of": "Bolivia",
    "bolivarian republic of": "Venezuela",
    "republic of korea": "South Korea",
    "usa": "United States",
    "us": "United States",
    "en:us": "United States",
    "en:united-states": "United States",
    "en:united states": "United States",
    "états-unis": "United States",
    "etats-unis": "United States",
    "united states of america": "United States",
    "uk": "United Kingdom",
    "en:gb": "United Kingdom",
    "en:uk": "United Kingdom",
    "en:united-kingdom": "United Kingdom",
    "en:united kingdom": "United Kingdom",
    "royaume-uni": "United Kingdom",
    "great britain": "United Kingdom",
    "england": "United Kingdom",
    "de": "Germany",
    "en:de": "Germany",
    "en:germany": "Germany",
    "deutschland": "Germany",
    "allemagne": "Germany",
    "alemania": "Germany",
    "fr": "France",
    "en:fr": "France",
    "en:france": "France",
    "francia": "France",
    "frankreich": "France",
    "es": "Spain",
    "en:es": "Spain",
    "en:spain": "Spain",
    "españa": "Spain",
    "espagne": "Spain",
    "spanien": "Spain",
    "it": "Italy",
    "en:it": "Italy",
    "en:italy": "Italy",
    "italia": "Italy",
    "italie": "Italy",
    "italien": "Italy",
    "nl": "Netherlands",
    "en:nl": "Netherlands",
    "en:netherlands": "Netherlands",
    "nederland": "Netherlands",
    "holland": "Netherlands",
    "pays-bas": "Netherlands",
    "be": "Belgium",
    "en:be": "Belgium",
    "en:belgium": "Belgium",
    "belgique": "Belgium",
    "belgië": "Belgium",
    "belgien": "Belgium",
    "ch": "Switzerland",
    "en:ch": "Switzerland",
    "en:switzerland": "Switzerland",
    "suisse": "Switzerland",
    "schweiz": "Switzerland",
    "svizzera": "Switzerland",
    "at": "Austria",
    "en:at": "Austria",
    "en:austria": "Austria",
    "österreich": "Austria",
    "autriche": "Austria",
    "pt": "Portugal",
    "en:pt": "Portugal",
    "en:portugal": "Portugal",
    "cz": "Czechia",
    "en:cz": "Czechia",
    "česko": "Czechia",
    "czech republic": "Czechia",
    "pl": "Poland",
    "en:pl": "Poland",
    "en:poland": "Poland",
    "polska": "Poland",
    "pologne": "Poland",
    "se": "Sweden",
    "en:se": "Sweden",
    "en:sweden": "Sweden",
    "sverige": "Sweden",
    "suède": "Sweden",
    "no": "Norway",
    "en:no": "Norway",
    "en:norway": "Norway",
    "norge": "Norway",
    "norvège": "Norway",
    "dk": "Denmark",
    "en:dk": "Denmark",
    "en:denmark": "Denmark",
    "danmark": "Denmark",
    "danemark": "Denmark",
    "fi": "Finland",
    "en:fi": "Finland",
    "en:finland": "Finland",
    "suomi": "Finland",
    "finlande": "Finland",
    "ru": "Russia",
    "en:ru": "Russia",
    "en:russia": "Russia",
    "russian federation": "Russia",
    "russie": "Russia",
    "jp": "Japan",
    "en:jp": "Japan",
    "en:japan": "Japan",
    "japon": "Japan",
    "cn": "China",
    "en:cn": "China",
    "en:china": "China",
    "chine": "China",
    "br": "Brazil",
    "en:br": "Brazil",
    "en:brazil": "Brazil",
    "brasil": "Brazil",
    "brésil": "Brazil",
    "ca": "Canada",
    "en:ca": "Canada",
    "en:canada": "Canada",
    "au": "Australia",
    "en:au": "Australia",
    "en:australia": "Australia",
    "australie": "Australia",
    "mx": "Mexico",
    "en:mx": "Mexico",
    "en:mexico": "Mexico",
    "méxico": "Mexico",
    "mexique": "Mexico",
    "ie": "Ireland",
    "en:ie": "Ireland",
    "en:ireland": "Ireland",
    "irlande": "Ireland",
    "gr": "Greece",
    "en:gr": "Greece",
    "en:greece": "Greece",
    "grèce": "Greece",
    "grecia": "Greece",
    "ro": "Romania",
    "en:ro": "Romania",
    "en:romania": "Romania",
    "roumanie": "Romania",
    "hu": "Hungary",
    "en:hu": "Hungary",
    "en:hungary": "Hungary",
    "magyarország": "Hungary",
    "hongrie": "Hungary",
}
