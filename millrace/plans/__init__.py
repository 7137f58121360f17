"""The concrete star schema: table specs, models, checks and registered queries."""
