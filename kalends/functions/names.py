"""Month and weekday names, fixed per language.

The names are data, not locale lookups, so that a calendar comes out the same on
every cluster whatever locale its JVMs run under.
"""

from __future__ import annotations

# Language code -> names of the twelve months (January first) and of
# the seven weekdays (Sunday first).
MONTHS = {
    "es": ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
           "Septiembre", "Octubre", "Noviembre", "Diciembre"],
    "en": ["January", "February", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December"],
    "pt": ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
           "Setembro", "Outubro", "Novembro", "Dezembro"],
    "ca": ["Gener", "Febrer", "Març", "Abril", "Maig", "Juny", "Juliol", "Agost",
           "Setembre", "Octubre", "Novembre", "Desembre"],
    "eu": ["Urtarrila", "Otsaila", "Martxoa", "Apirila", "Maiatza", "Ekaina", "Uztaila", "Abuztua",
           "Iraila", "Urria", "Azaroa", "Abendua"],
    "gl": ["Xaneiro", "Febreiro", "Marzo", "Abril", "Maio", "Xuño", "Xullo", "Agosto",
           "Setembro", "Outubro", "Novembro", "Decembro"],
    "fr": ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août",
           "Septembre", "Octobre", "Novembre", "Décembre"],
}
DAYS = {
    "es": ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"],
    "en": ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"],
    "pt": ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado"],
    "ca": ["Diumenge", "Dilluns", "Dimarts", "Dimecres", "Dijous", "Divendres", "Dissabte"],
    "eu": ["Igandea", "Astelehena", "Asteartea", "Asteazkena", "Osteguna", "Ostirala", "Larunbata"],
    "gl": ["Domingo", "Luns", "Martes", "Mércores", "Xoves", "Venres", "Sábado"],
    "fr": ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"],
}
DEFAULT_LANGUAGE = "es"


def check_language(lang: str) -> str:
    """Return ``lang`` when names exist for it; otherwise say which codes do."""
    if lang not in MONTHS:
        raise ValueError(f"no names for language {lang!r}; choose one of {', '.join(sorted(MONTHS))}")
    return lang
