"""The engine on the given tables, which hold no trips: each question runs on a stand-in."""
