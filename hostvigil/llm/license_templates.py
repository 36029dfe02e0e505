"""License notices as templates.

Markup: ``{{...}}`` encloses wording that may be absent, ``[[least,most]]`` stands for so many
words of any kind, ``[[least,most|examples]]`` likewise with a note on what usually stands there.
Everything else is mandatory wording.
"""

# The wording of public license notices.
TEMPLATES = {
    "mit": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the [[0,4|"Software"]]), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice {{(including the next
        paragraph)}} shall be included in all copies or substantial portions of the Software.
        """,
    "mit-notice": "{{This [[1,3|software, project, work]] is}} licensed under the {{terms of the}}"
                  " MIT License",
    "isc": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.
        """,
    "bsd": """
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: {{1}} Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following
        disclaimer.
        """,
    "apache-2.0": """
        Licensed under the Apache License, Version 2.0 {{(the [[0,2|"License"]]); you may not use
        this file except in compliance with the License}}
        """,
    "gpl": """
        {{This [[1,3|work, program, library]] is}} licensed under the GNU {{Lesser}} {{Affero}}
        General Public License, version [[1,1|2, 3]]
        """,
    "gpl-notice": """
        This [[1,3|program, library]] is free software{{:}} you can redistribute it and/or modify
        it under the terms of the GNU {{Lesser}} {{Affero}} General Public License as published by
        the Free Software Foundation
        """,
    "cc-by-nc-4.0": "Licensed under {{a}} {{the}} {{Creative Commons}} CC BY NC 4.0",
    "cc-by-4.0": """
        licensed under a Creative Commons Attribution 4.0 International License
        """,
    "mpl-2.0": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        """,
    "spdx": "SPDX License Identifier [[1,1|MIT]] {{[[1,3]] only}}",
    "all-rights-reserved": "Copyright {{c}} [[1,8|year and holder]] All rights reserved",
}

# Phrases that count wherever they stand, and the labels they give.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
