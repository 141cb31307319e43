"""Residue in wordings that no exemplar was written from.

Each set was written before it was looked at with the operator and measured
once: FIRST 43 of 61 found, SECOND 37 of 54.  The exemplars were then widened
by families for what was missed, so neither is a held-out set any more.
"""

from corpusloom.llm import residue

FIRST = [
    # error pages
    "Hmm, we can't seem to find that page.", "Sorry! That vacancy seems to have vanished.", "The requested URL was not found on this server.",
    "This site can't be reached", "Your connection was interrupted", "Error 502: the upstream server is not responding", "We hit a snag while loading this job",
    "The address you typed does not exist on our site", "Oh no! This content is currently unavailable", "HTTP Status 500 - Internal Server Error", "Whoops, that link has expired.",
    "The document you requested cannot be located", "You don't have permission to access this resource", "The job you tried to open has been taken down",
    "Our server encountered an error and could not complete your request", "Request blocked by security policy", "Diese Stelle ist leider nicht mehr verfügbar.",
    "Der Server antwortet nicht", "La oferta que buscas ya no existe", "Cette annonce a été supprimée", "Le serveur ne répond pas",
    # scripts
    "JavaScript seems to be disabled in your browser", "To use this form, please allow scripts and reload", "Scripts are blocked, so this board cannot be shown",
    "We're sorry but this application doesn't work properly without JavaScript enabled", "Turn on JavaScript to see this vacancy", "This content needs JavaScript switched on",
    "Bitte schalten Sie JavaScript ein", "Für diese Seite muss JavaScript aktiviert sein", "Debe activar JavaScript para ver esta página",
    # filler
    "Description will be added here", "Copy to come", "Insert your own text", "Write your description here", "This paragraph is placeholder copy", "TODO: write this",
    "Lorem ipsum dolor sit amet, consectetur adipiscing", "Sed ut perspiciatis unde omnis iste natus error sit voluptatem", "Text wird noch ergänzt", "Aquí va el texto", "Texte provisoire",
    "Details to be confirmed", "Sample content", "bla bla bla bla", "Placeholder description", "asdfasdf asdfasdf asdfasdf",
    # placeholders
    "We are {{ employer.name }} and we care", "Report to ${line_manager}", "Salary: <<pay_band>>", "Join the [Team Name] crew", "Based in {city}", "Hello %FIRSTNAME%", "Dear [Candidate],",
    "Location: __CITY__", "Starts on <%= start_date %>", "Contact: @@recruiter_email@@", "Dept: [[department]]", "Wage: %d a year", "Company: undefined", "Posted by xxxx", "[Insert company blurb]",
]
CONTENT = [
    "You fix pages that customers report as broken", "Write clear error messages for our checkout", "Own the 404 page and its analytics", "Support staff whose sessions expire too soon",
    "Explain to users why a request was denied", "call __init__ of the class", "C++ uses << operator and >> operator", "Set %%timeit in the notebook %%", "Know Handlebars {{ name }} and bash ${HOME} well",
    "Deal with undefined behaviour in legacy code", "Null or undefined values do not scare you", "Our JavaScript team ships weekly", "Make sites work without JavaScript", "Scripts in Python and Bash",
    "You write product descriptions for our shop", "Copy and content for the web", "Experience with sample preparation", "Add descriptions to data sets", "Salary: 40,000 [negotiable]", "Flexible start [full time]",
    "The position is available from May", "This post has been extended to June", "The service is available around the clock", "Pages load fast because of you", "Text mining and content analysis",
    "Details of the role are in the pack", "Replace old servers before they fail", "Keep the gateway up", "Use {x, y} and [i] in proofs", "List<String> and Map<K, V> in Java", "printf with %s and %d", "Server and service design",
    "We enable teams to work in the browser", "Files are removed after a year", "Links between teams matter here", "A document that explains the offer", "Read the job description to the end", "Todo lists and notes are your friends",
]


SECOND = [
    # error pages
    "404: nothing lives at this address", "That job has flown the nest and is no longer available", "The website encountered an unexpected error. Please try again later.",
    "This webpage is not available", "The server refused the connection", "Bad request", "Your request could not be processed at this time", "An internal error has occurred, reference 8812",
    "We are sorry, the file you are trying to open does not exist", "Session timed out, please sign in once more", "Gateway time-out", "The requested advert has been deleted by the employer",
    "Unable to load vacancy", "Page temporarily unavailable", "This link no longer works", "Die angeforderte Seite konnte nicht geladen werden", "Fehler 404", "Error al cargar la oferta", "Erreur interne du serveur",
    # scripts
    "Scripting is turned off - turn it on to go on", "Our board only works with JavaScript", "You have JavaScript disabled", "Allow JavaScript and try again", "This viewer depends on JavaScript, which is blocked",
    "JavaScript wird benötigt, um diese Anzeige zu sehen", "Merci d'activer JavaScript pour continuer", "Active JavaScript para ver la oferta",
    # filler
    "Text to be supplied by HR", "Your headline here", "Enter your description here", "Duties: TBC TBC TBC", "Nulla facilisi morbi tempus iaculis urna id volutpat", "content to follow shortly", "lorem lorem lorem",
    "Beschreibung folgt", "Descripción pendiente", "Description à venir", "This is sample copy", "Paste your text here",
    # placeholders
    "Join {{client_name}} today", "Pay: ${currency}${amount}", "Apply before {deadline}", "At <Company Name> we care", "Your manager: [Hiring Manager]", "Office in %%OFFICE_CITY%%", "Start date: __START__", "Hours: {{hours}}",
    "Welcome to #{org}", "Bonus of <%= bonus %>", "Location: xxx", "Name: undefined", "{% block intro %}", "Reports to @@line_lead@@", "Salary %s per month",
]
SECOND_CONTENT = [
    "You build services that handle bad requests well", "Experience with session handling", "Keep the web site available day and night", "You load vans and unload trailers", "You have JavaScript experience",
    "Knowledge of JavaScript frameworks is a plus", "Description of the post", "Follow the text of the law", "Headlines are your craft", "You join a team of 12 people", "Apply before 1 May", "Start date to be agreed",
    "Bonus of 5 % on top", "Use of __slots__ and dataclasses", "a << 2 shifts bits", "Read {x | x > 0} aloud", "Our offices [Leeds, York] are open", "Reports <weekly> to the board", "Undefined variables and null pointers", "Not found elsewhere: a real canteen",
    "The job no longer requires travel", "Files are deleted on request", "You answer requests within a day", "Scripts for radio plays", "The page layout is yours", "Errors are how we learn",
]


def shares(residue_texts, content):
    labels = residue.label_all(residue_texts + content * 4)
    missed = [t for t, label in zip(residue_texts, labels) if not label]
    wrong = [t for t, label in zip(content, labels[len(residue_texts) :]) if label]
    return 1 - len(missed) / len(residue_texts), wrong


def test_wordings_the_exemplars_were_widened_for():
    assert shares(FIRST, CONTENT)[0] >= 0.95 and shares(FIRST, CONTENT)[1] == []
    assert shares(SECOND, SECOND_CONTENT)[0] >= 0.95 and shares(SECOND, SECOND_CONTENT)[1] == []


def test_talk_of_code_is_no_gap():
    found = ["Sorry, the content you requested has been removed", "Your browser has cookies and scripts turned off", "Your text could be here", "FIXME describe role", "The resource cannot be located", "Our group needs an images operator with #{benefit}"]
    talk = ["call __init__ of the class", "C++ uses << operator and >> operator", "Set %%timeit in the notebook %%", "Write handlebars such as {{ name }} and bash like ${HOME}", "Undefined behaviour", "Strings such as xxx or %s"]
    labels = residue.label_all(found + talk + CONTENT)
    assert all(labels[: len(found)]) and not any(labels[len(found) :])


def test_notices_cut_by_windows():
    """A notice is found wherever it stands in a long passage, on either side of a window's end."""
    for ahead in range(0, 130, 7):
        text = " ".join(["rail"] * ahead) + " please enable javascript and cookies to continue " + " ".join(["sites"] * 100)
        assert residue.label_all([text, "Our rail desk looks after sites"] + CONTENT)[0] == "scripts required"
