"""Column functions: URLs, domains, robots directives."""
