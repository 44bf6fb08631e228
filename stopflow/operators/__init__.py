"""Analytics over validations, features and profiles."""
