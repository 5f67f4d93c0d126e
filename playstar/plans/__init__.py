"""The warehouse itself: calendars, star schema, lifecycle, loads, reports."""
