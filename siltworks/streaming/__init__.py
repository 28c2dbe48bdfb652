"""The same operators on tables that keep growing."""
