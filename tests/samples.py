"""Hand-made records for the cases the generated tables do not contain."""

import json

SONGS = [
    {"song_id": "SOPAPERBOATS000001", "num_songs": 1, "title": "Paper Boats", "artist_name": "Glass Harbour",
     "artist_latitude": None, "year": 0, "duration": 161.25, "artist_id": "ARGLASSHARBOUR0001",
     "artist_longitude": None, "artist_location": ""},
    {"song_id": "SODONTWAIT00000002", "num_songs": 1, "title": "Don't Wait (For Me)", "artist_name": "The Tidewaters",
     "artist_latitude": 54.4858, "year": 1981, "duration": 402.5, "artist_id": "ARTIDEWATERS000002",
     "artist_longitude": -0.6206, "artist_location": "Whitby, England"},
    {"song_id": "SOLETO000000000003", "num_songs": 1, "title": "Léto u řeky", "artist_name": "Jiřina",
     "artist_latitude": None, "year": 2011, "duration": 233.75, "artist_id": "ARJIRINA0000000003",
     "artist_longitude": None, "artist_location": "Třebíč, Česko"},
    {"song_id": "SONOPLACE", "num_songs": 1, "title": "Somewhere", "artist_name": "Nowhere Band",
     "artist_latitude": None, "year": 1999, "duration": 1200.5, "artist_id": "ARNOPLACE",
     "artist_longitude": None, "artist_location": None},
]

PLAY = {
    "artist": "The Tidewaters", "auth": "Logged In", "firstName": "Ada", "gender": "F", "itemInSession": 0,
    "lastName": "Day", "length": 402.5, "level": "free", "location": "Oslo", "method": "PUT",
    "page": "NextSong", "registration": 1540919166796.0, "sessionId": 12, "song": "Don't Wait (For Me)",
    "status": 200, "ts": 1542241826796, "userAgent": "agent", "userId": "7",
}


def play(**changes):
    return {**PLAY, **changes}


def write_lines(path, records):
    """One JSON object per line; text is written as it is."""
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=True) for r in records]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
