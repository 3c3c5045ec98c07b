"""Sample sentences of the built-in language model, about the same things in every language.

They are a start for reviews without labelled data; pass a model fitted on a labelled table
for real use.
"""

SAMPLES = {
    "de": (
        "Die Bank ist gut gelegen und die Mitarbeiter sind sehr freundlich. Leider muss man immer lange warten, "
        "weil nur ein Schalter geöffnet ist. Ich habe mein Konto vor drei Jahren hier eröffnet und bin mit dem "
        "Service zufrieden. Der Geldautomat funktioniert nicht und niemand geht ans Telefon. Die Beratung war "
        "schnell und kompetent, aber die Gebühren sind zu hoch. Man hat mir nicht geholfen und ich werde die Bank "
        "wechseln. Wir empfehlen diese Filiale unseren Freunden und kommen gerne wieder."
    ),
    "en": (
        "The bank is well located and the staff are very friendly. Unfortunately you always have to wait for a "
        "long time because only one counter is open. I opened my account here three years ago and I am happy with "
        "the service. The cash machine does not work and nobody answers the phone. The advice was quick and "
        "professional, but the fees are too high. They did not help me and I will change my bank. We recommend "
        "this branch to our friends and would gladly come back again."
    ),
    "es": (
        "El banco está bien situado y el personal es muy amable. Por desgracia siempre hay que esperar mucho "
        "tiempo porque solo hay una ventanilla abierta. Abrí mi cuenta aquí hace tres años y estoy contento con el "
        "servicio. El cajero automático no funciona y nadie contesta al teléfono. La atención fue rápida y "
        "profesional, pero las comisiones son demasiado altas. No me ayudaron y voy a cambiar de banco. "
        "Recomendamos esta sucursal a nuestros amigos y volveremos con mucho gusto."
    ),
    "fr": (
        "La banque est bien située et le personnel est très aimable. Malheureusement il faut toujours attendre "
        "longtemps parce qu'un seul guichet est ouvert. J'ai ouvert mon compte ici il y a trois ans et je suis "
        "content du service. Le distributeur ne fonctionne pas et personne ne répond au téléphone. Le conseil "
        "était rapide et professionnel, mais les frais sont trop élevés. On ne m'a pas aidé et je vais changer de "
        "banque. Nous recommandons cette agence à nos amis et nous reviendrons avec plaisir."
    ),
    "it": (
        "La banca si trova in una buona posizione e il personale è molto gentile. Purtroppo bisogna sempre "
        "aspettare a lungo perché è aperto un solo sportello. Ho aperto il mio conto qui tre anni fa e sono "
        "contento del servizio. Lo sportello automatico non funziona e nessuno risponde al telefono. La consulenza "
        "è stata rapida e professionale, ma le commissioni sono troppo alte. Non mi hanno aiutato e cambierò "
        "banca. Consigliamo questa filiale ai nostri amici e torneremo volentieri."
    ),
    "pt": (
        "O banco está bem localizado e os funcionários são muito simpáticos. Infelizmente é sempre preciso esperar "
        "muito tempo porque só há um balcão aberto. Abri a minha conta aqui há três anos e estou satisfeito com o "
        "serviço. O caixa automático não funciona e ninguém atende o telefone. O atendimento foi rápido e "
        "profissional, mas as taxas são demasiado altas. Não me ajudaram e vou mudar de banco. Recomendamos esta "
        "agência aos nossos amigos e voltaremos com muito prazer."
    ),
}
